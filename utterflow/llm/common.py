"""Helpers shared by the training-data operators: written tables, Arrow text batches, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.tables import read_table

WHITE = " \t\n\x0b\x0c\r"          # [\x20\x09-\x0D]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROWS_PER_BATCH = 256               # texts handled together in Python: bounds a worker's memory


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there,
    so a lost executor never recomputes what came before."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c):
    """Lower-case A-Z only; the fast built-in is exact where every character is ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)) \
        .otherwise(F.translate(c, UPPER, UPPER.lower()))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = ROWS_PER_BATCH) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of at most ``rows`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def spread_key(c: str):
    """A further join key that follows from ``c``. Aggregates that are joined on it as well get an
    exchange of their own, and only with one can the skew join split the other side's hot keys."""
    return F.pmod(F.hash(c), F.lit(1 << 16))


def row_key(df: DataFrame, text_col: str):
    """Key of a row by its text's SHA-256 and a hash of its text and number columns: rows of one key have one text."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.StringType | T.NumericType)]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return F.concat(F.sha2(text.cast("binary"), 256), F.hex(F.xxhash64(*plain)))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph given as rows (a, b) of longs.

    Alternating large-star and small-star steps: each round is a map-side
    combined minimum per node joined back to the edges, written to the shared
    folder. The minima are shuffled by a key of their own for that join, so that
    the skew join can split the edges of a hub. Rounds grow with the logarithm
    of the longest chain. Returns (node, root) with root the smallest
    node of the component; isolated nodes and null ends don't appear.
    """
    def with_low(e: DataFrame) -> DataFrame:
        low = e.groupBy("a").agg(F.min("b").alias("m")) \
            .select(F.col("a").alias("k"), F.least("a", "m").alias("m"), spread_key("a").alias("part"))
        return e.withColumn("part", spread_key("a")).join(low, ["part"]).where("a = k")

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a != b").distinct(), "edges")
    seen = mark(e)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = e.union(e.select("b", "a").toDF("a", "b"))
        large = with_low(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        small = with_low(large)          # every b is smaller than its a
        e = written(small.select("a", F.col("m").alias("b"))
                    .union(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
                    .where("a != b").distinct(), "edges")
        now = mark(e)
        if tuple(now) == tuple(seen):
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
