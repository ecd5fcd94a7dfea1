"""File trees listed by the executors, level by level.

A level is a table of folders; tasks list their entries, which are written to
the shared folder, and the folders among them are the next level. Only the
number of folders comes to the driver, so a tree of any number of files can be
listed; the largest unit is the listing of one folder.
"""

from __future__ import annotations

import fnmatch
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .storage import open_root, patterns_of, qualified

ENTRIES = "rel string, name string, length long, folder boolean"
ROWS, BYTES = 10_000, 8 << 20      # of one Arrow batch
SPLIT_BYTES, FILE_COST = 64 << 20, 256 << 10


def _expand(root: str):
    """Entries of folders, by their paths below ``root``; hidden entries are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_root(root)
        for b in batches:
            for rel in b.column(0).to_pylist():
                found = fs.get_file_info(pafs.FileSelector(f"{base}/{rel}" if rel else base))
                found = [f for f in found if not f.base_name.startswith(".") and f.base_name != "_temporary"]
                for i in range(0, len(found), ROWS):
                    some = found[i:i + ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f"{rel}/{f.base_name}" if rel else f.base_name for f in some]),
                         pa.array([f.base_name for f in some]), pa.array([f.size for f in some], pa.int64()),
                         pa.array([f.type == pafs.FileType.Directory for f in some])], ["rel", "name", "length", "folder"])
    return run


def list_tree(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(rel, name, path, length) of every file below ``root`` whose name matches ``glob``.

    ``rel`` is the path below the root; names are as they are, never
    percent-encoded. Entries whose names begin with a dot, and what lies in such
    folders, are left out. A root that is a file is its own listing; a missing
    one is an error.
    """
    root = qualified(spark, root).rstrip("/")
    fs, base = open_root(root)
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(root)
    if info.type == pafs.FileType.File:
        files = spark.createDataFrame([(info.base_name, info.base_name, info.size, False)], ENTRIES)
        root = root.rpartition("/")[0]
    else:
        out = scratch_path(spark, f"listing-{uuid.uuid4().hex}")
        folders, n, level = spark.createDataFrame([("",)], "rel string"), 1, 0
        wide = spark.sparkContext.defaultParallelism
        while n:
            tasks = min(n, 4 * wide) if n < 10_000 else min(n // 64, 10_000)
            folders.repartition(tasks).mapInArrow(_expand(root), ENTRIES).write.parquet(f"{out}/level={level}")
            folders = spark.read.schema(ENTRIES).parquet(f"{out}/level={level}").where("folder").select("rel")
            n, level = folders.count(), level + 1
        files = spark.read.schema(ENTRIES).parquet(*(f"{out}/level={k}" for k in range(level))).where("not folder")
    wanted = [fnmatch.translate(p) for p in patterns_of(glob)]
    if "*" not in patterns_of(glob):
        files = files.where(F.col("name").rlike("|".join(f"(?:{_java(w)})" for w in wanted)))
    return files.select("rel", "name", F.concat(F.lit(f"{root}/"), "rel").alias("path"), "length")


def _java(pattern: str) -> str:
    """A translated file-name pattern in Java's syntax; ``rlike`` searches, so it is anchored at both ends."""
    return "^" + pattern.replace(r"\Z", r"\z")


def read_contents(files: DataFrame, spark: SparkSession) -> DataFrame:
    """The columns of ``files`` (with path and length) and ``content``: each file read whole by one task.

    Files are dealt so that a task has some 64 MB, whatever their sizes' order.
    """
    size = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    cost = size["bytes"] + FILE_COST * size["n"]
    tasks = max(1, min(size["n"], max(-(-cost // SPLIT_BYTES), spark.sparkContext.defaultParallelism)))
    schema = ", ".join(f"`{c}` {t}" for c, t in files.dtypes) + ", content binary"
    at = files.columns.index("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, first = [], 0, 0
            for k, path in enumerate(b.column(at).to_pylist()):
                fs, name = open_root(path)
                with fs.open_input_stream(name, compression=None) as f:
                    held.append(f.read())
                size += len(held[-1])
                if size >= BYTES:
                    yield pa.RecordBatch.from_arrays([*b.slice(first, len(held)).columns, pa.array(held, pa.binary())],
                                                     [*b.schema.names, "content"])
                    held, size, first = [], 0, k + 1
            if held:
                yield pa.RecordBatch.from_arrays([*b.slice(first, len(held)).columns, pa.array(held, pa.binary())],
                                                 [*b.schema.names, "content"])

    return files.repartition(tasks).mapInArrow(run, schema)
