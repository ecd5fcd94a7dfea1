"""Datasets from generator functions, one task a unit.

A builder lists its units (files, archives, row groups, pages of a service) and
gives a function from a unit to Arrow batches or rows. The driver holds the
units, never what they generate.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 1000        # of a batch made from single rows


class _Unit(InputPartition):
    def __init__(self, split: str | None, unit: Any):
        super().__init__((split, unit))
        self.split, self.unit = split, unit


def _batches(made: Iterable, schema: pa.Schema) -> Iterable[pa.RecordBatch]:
    """Batches with the columns of ``schema`` by name; single rows, dicts or sequences, are gathered."""
    held: list = []

    def gathered():
        rows = [r if isinstance(r, Mapping) else dict(zip(schema.names, r, strict=True)) for r in held]
        return pa.RecordBatch.from_pylist(rows, schema)

    for item in made:
        if isinstance(item, pa.RecordBatch | pa.Table):
            if held:
                yield gathered()
                held = []
            table = item if isinstance(item, pa.Table) else pa.Table.from_batches([item])
            yield from table.select(schema.names).cast(schema).to_batches()
        else:
            held.append(item)
            if len(held) >= ROWS:
                yield gathered()
                held = []
    if held:
        yield gathered()


def from_generator(spark: SparkSession, units: Sequence | Mapping[str, Sequence], generate: Callable[[Any], Iterable],
                   schema: T.StructType | str) -> DataFrame:
    """The rows of ``generate(unit)`` for every unit, one input partition each.

    ``generate`` runs in tasks, yields Arrow batches, tables or rows, and must
    give the same rows when a lost task is run again. With a mapping from splits
    to units, rows get a first column ``split``. Columns that ``schema`` has and a
    batch hasn't are an error; further ones are dropped.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    named = isinstance(units, Mapping)
    flat = [_Unit(s, u) for s, some in units.items() for u in some] if named else [_Unit(None, u) for u in units]
    full = T.StructType([T.StructField("split", T.StringType()), *declared.fields]) if named else declared
    if not flat:
        return spark.createDataFrame([], full)

    class Generated(DataSource):
        @classmethod
        def name(cls) -> str:
            return f"generated_{token}"

        def schema(self) -> T.StructType:
            return full

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    class Reader(DataSourceReader):
        def partitions(self):
            return flat

        def read(self, partition):
            arrow = to_arrow_schema(declared)
            for b in _batches(generate(partition.unit), arrow):
                if named:
                    split = pa.array([partition.split] * b.num_rows, pa.string())
                    b = pa.RecordBatch.from_arrays([split, *b.columns], ["split", *arrow.names])
                yield b

    token = uuid.uuid4().hex
    spark.dataSource.register(Generated)
    return spark.read.format(Generated.name()).load()


def parquet_row_groups(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(file, row group) of a parquet file or folder: units to generate from."""
    import pyarrow.parquet as pq

    from .storage import list_matching, open_root, qualified
    path = qualified(spark, path)
    out = []
    for name in list_matching(path) or list_matching(f"{path}/*"):
        if name.endswith(".parquet"):
            fs, file = open_root(name)
            with fs.open_input_file(file) as f:
                out += [(name, g) for g in range(pq.ParquetFile(f).num_row_groups)]
    return out


def read_row_group(unit: tuple[str, int], columns: list[str]) -> Iterable[pa.RecordBatch]:
    import pyarrow.parquet as pq

    from .storage import open_root
    fs, file = open_root(unit[0])
    with fs.open_input_file(file) as f:
        yield from pq.ParquetFile(f).iter_batches(ROWS, row_groups=[unit[1]], columns=columns)
