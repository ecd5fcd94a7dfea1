"""Sinks (K1-K4): per-split metadata.csv, sharded parquet, materialization."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from . import storage
from .tarshards import GroupWriter

# CSV settings that keep " " and "" apart through a write/read round trip:
# Spark trims and turns "" into null by default.
_CSV_WRITE = {"header": "true", "quoteAll": "true", "quote": '"', "escape": '"',
              "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
              "emptyValue": '""', "encoding": "UTF-8"}
_CSV_READ = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
             "emptyValue": "", "nullValue": "\u0000\u0001"}


def write_metadata_csv(df: DataFrame, root: str, split: str | None = "split", mode: str = "overwrite") -> None:
    """K1/K2: metadata.csv, quote-all with header; per split folder when ``split`` is set.

    The split column is dropped from the files (it is the folder name). Files
    stay sharded (one per task); no coalesce to a single writer.
    """
    w = df.write.mode(mode).options(**_CSV_WRITE)
    if split:
        w = w.partitionBy(split)
    w.csv(root)


def read_metadata_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.options(**_CSV_READ)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def publish(df: DataFrame, path: str, rows_per_file: int = 100_000, split: str | None = "split",
            mode: str = "error") -> None:
    """K3: sharded columnar files, one folder per split, bounded rows per file.

    An existing target is an error unless ``mode`` says otherwise.
    """
    w = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if split:
        w = w.partitionBy(split)
    w.parquet(path)


def materialize(df: DataFrame, path: str, schema: T.StructType | None = None) -> DataFrame:
    """K4: write a lazy plan out and read it back (cuts lineage; survives
    executor loss because the data now lives in the shared folder), restoring
    the declared schema."""
    schema = schema or df.schema
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _staged(spark: SparkSession, root: str) -> tuple[str, str]:
    """``root`` as a URI and a hidden folder in it, new for every job."""
    root = storage.qualified(spark, root).rstrip("/")
    return root, f"{root}/.staging-{uuid.uuid4().hex}"


def _published(staged: DataFrame, root: str, hidden: str) -> DataFrame:
    """Two phases: all files are written under hidden names, then moved to ``root``/<relpath>.

    ``staged`` writes files as it is evaluated and yields (relpath, staged, ...).
    It is written as a table, so Spark keeps the rows of one attempt of each
    task; files of other attempts are in no row and go with the hidden folder.
    Only when every file is there, tasks move them; a move that a lost executor
    had made already is not made twice. If the job fails before, nothing is
    visible. Names come to no driver. Returns the table without ``staged``.
    """
    spark = staged.sparkSession
    fs, folder = storage.open_root(hidden)
    fs.create_dir(folder, recursive=True)
    schema = staged.schema
    try:
        manifest = scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
        staged.write.parquet(manifest)
        rows = spark.read.schema(schema).parquet(manifest)
        twice = rows.groupBy("relpath").count().where("count > 1").first()
        if twice:
            raise ValueError(f"more than one row for {twice['relpath']}")

        def move(batches):
            fs, base = storage.open_root(root)
            made = set()
            for b in batches:
                for rel, name in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    to, at = f"{base}/{rel}", f"{folder}/{name}"
                    if (parent := to.rpartition("/")[0]) not in made:
                        fs.create_dir(parent, recursive=True)
                        made.add(parent)
                    try:
                        fs.move(at, to)
                    except OSError:
                        kinds = [i.type for i in fs.get_file_info([at, to])]
                        if kinds != [pafs.FileType.NotFound, pafs.FileType.File]:
                            raise
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

        rows.select("relpath", "staged").mapInArrow(move, "n long").write.format("noop").mode("overwrite").save()
    finally:
        fs.delete_dir(folder)
    return rows.drop("staged")


def write_files(df: DataFrame, root: str, relpath: str = "relpath", content: str = "content") -> DataFrame:
    """One file per row at root/<relpath> (e.g. sidecar texts, audio files); returns (relpath, n_bytes) of them.

    Executors write their own rows; see ``_published`` for when they show. Two
    rows with one path, or a row without path or content, are an error; an
    existing file is replaced. ``root`` is storage that all nodes share.
    """
    root, hidden = _staged(df.sparkSession, root)

    def run(batches):
        fs, base = storage.open_root(hidden)
        for b in batches:
            names, sizes = [], []
            for rel, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if rel is None or data is None:
                    raise ValueError("a file needs a path and content")
                names.append(uuid.uuid4().hex)
                sizes.append(len(data))
                with fs.open_output_stream(f"{base}/{names[-1]}", compression=None) as f:
                    f.write(data)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array(names, pa.string()), pa.array(sizes, pa.int64())],
                                             ["relpath", "staged", "n_bytes"])

    return _published(df.select(F.col(relpath), F.col(content)).mapInArrow(run, "relpath string, staged string, n_bytes long"), root, hidden)


def write_tar_shards(df: DataFrame, root: str, shard: str = "shard", member: str = "member",
                     content: str = "content", n_partitions: int | None = None, group_bytes: int = 4 << 20) -> DataFrame:
    """tar.gz shards root/<shard>.tar.gz; returns (shard, n_members) of them.

    Rows are hash-partitioned by shard and sorted by it, and each task streams
    one shard after the other, in groups from which ``tarshards`` can begin to
    read; see ``_published`` for when the shards show. All members of a shard land
    in one task (shards are files of bounded size). ``root`` is storage that all
    nodes share."""
    root, hidden = _staged(df.sparkSession, root)
    parts = df.select(F.col(shard).cast("string").alias("_shard"), F.col(member).alias("_member"),
                      F.col(content).alias("_content"))
    # without an explicit count AQE sizes the writer tasks (a task may write several shards)
    parts = parts.repartition(n_partitions, "_shard") if n_partitions else parts.repartition("_shard")

    def run(batches):
        fs, base = storage.open_root(hidden)
        shard, name, out, tar, n = None, None, None, None, 0

        def finish():
            tar.close()
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{shard}.tar.gz"]), pa.array([name]), pa.array([shard]), pa.array([n], pa.int64())],
                                              ["relpath", "staged", "shard", "n_members"])

        for b in batches:
            for s, m, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if tar is None or s != shard:
                    if tar is not None:
                        yield finish()
                    shard, n, name = s, 0, uuid.uuid4().hex
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    tar = GroupWriter(out, group_bytes)
                tar.add(m, data)
                n += 1
        if tar is not None:
            yield finish()

    written = parts.sortWithinPartitions("_shard", "_member").mapInArrow(run, "relpath string, staged string, shard string, n_members long")
    return _published(written, root, hidden).select("shard", "n_members")
