"""Manifests stored by path, so that reconciling them again and again shuffles nothing.

Each manifest is a parquet table in buckets of its key, one sorted file a bucket.
Tables of one store have the same number of buckets: joins on the key, and
groupings by it, read bucket beside bucket without an exchange.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import storage


class ManifestStore:
    """Tables below ``root`` (storage that all nodes share), bucketed by ``key``.

    The number of buckets is the store's, for good: some 100 MB of the largest
    manifest each is a good size. Another session finds the tables by what is
    written beside them.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 200, key: str = "path"):
        self.spark, self.root = spark, storage.qualified(spark, root).rstrip("/")
        self.buckets, self.key, self.tables = buckets, key, {}

    def _spec(self, name: str) -> str:
        return f"{self.root}/{name}.json"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Store ``df`` under ``name``, in place of what is there, and read it back.

        Rows are shuffled by the key here, once; every task writes whole buckets.
        """
        table = f"manifest_{uuid.uuid4().hex}"
        folder = f"{self.root}/{name}-{uuid.uuid4().hex}"            # a reader of the table before keeps its files
        (df.repartition(self.buckets, self.key).write.format("parquet").option("path", folder)
         .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(table))
        spec = {"folder": folder, "schema": df.schema.json(), "buckets": self.buckets, "key": self.key}
        fs, path = storage.open_root(self._spec(name))
        with fs.open_output_stream(path, compression=None) as f:
            f.write(json.dumps(spec).encode())
        self.tables[name] = table
        return self.spark.table(table)

    def get(self, name: str) -> DataFrame:
        """The table stored under ``name``, by this session or another."""
        if name not in self.tables:
            fs, path = storage.open_root(self._spec(name))
            with fs.open_input_stream(path, compression=None) as f:
                spec = json.loads(f.read())
            if (spec["buckets"], spec["key"]) != (self.buckets, self.key):
                raise ValueError(f"{name} has {spec['buckets']} buckets by {spec['key']}, the store {self.buckets} by {self.key}")
            table = f"manifest_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(spec["schema"])))
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{spec['folder']}'")
            self.tables[name] = table
        return self.spark.table(self.tables[name])
