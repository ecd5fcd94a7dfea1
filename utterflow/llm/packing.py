"""Best-fit packing of documents into training sequences under conflicts.

Bins are kept in order of what is left in them and carry a bitmap of the
sources and one of the duplicate clusters they hold. Pieces go in by falling
length; a successor search starts at the first bin that is large enough and
goes on until it finds the tightest one that holds neither the piece's source
nor its cluster. Documents are dealt by a hash into shards of about
``shard_rows``, whatever the cluster, so a hot source or a large group of copies
is spread over all shards and a task holds one bounded shard of lengths, never
texts.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, written
from .simhash import fingerprints, with_roots

CAPACITY = 8192                  # code points in a sequence
SHARD_ROWS = 4096                # documents packed together (on average)
COPIES = 4096                    # equal rows numbered by one task at a time


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item (length, source bit, cluster bit), taken in the order given.

    Bits are 0 where nothing conflicts. Of equally tight bins the oldest is taken.
    """
    order: list[tuple[int, int]] = []            # (left, bin), ascending
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for length, source, cluster in items:
        i = bisect_left(order, (length, -1))
        while i < len(order):
            b = order[i][1]
            if not (sources[b] & source or clusters[b] & cluster):
                break
            i += 1
        if i < len(order):
            left, b = order.pop(i)
        else:
            left, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        insort(order, (left - length, b))
        out.append((b, capacity - left))
    return out


def _bits(values: pd.Series) -> list[int]:
    """A bit for each value that comes more than once, 0 for the others and for null."""
    counts = values.value_counts()
    bit = {v: 1 << i for i, v in enumerate(counts.index[counts > 1])}
    return [bit.get(v, 0) for v in values]


def pack_shard(pdf: pd.DataFrame, capacity: int, by: list[str]) -> pd.DataFrame:
    """Rows (piece, start, length, bin, bin_offset) for one shard of (row, shard, length, source, cluster).

    A document longer than ``capacity`` fills bins of its own; only the rest of it is packed.
    """
    pdf = pdf.sort_values(by).reset_index(drop=True)
    full = pdf["length"] // capacity
    rest = pdf["length"] - full * capacity
    packed = pdf.assign(rest=rest)[(rest > 0) | (full == 0)].sort_values("rest", ascending=False, kind="stable")
    places = best_fit(list(zip(packed["rest"].tolist(), _bits(packed["source"]), _bits(packed["cluster"]), strict=True)), capacity)
    out = [packed.assign(piece=full[packed.index], start=full[packed.index] * capacity, length=packed["rest"],
                         bin=[b for b, _ in places], bin_offset=[o for _, o in places])]
    used = 1 + max((b for b, _ in places), default=-1)
    whole = pdf.loc[pdf.index.repeat(full)]
    if len(whole):
        n = whole.groupby(level=0).cumcount()
        out.append(whole.assign(piece=n, start=n * capacity, length=capacity, bin=range(used, used + len(whole)), bin_offset=0))
    return pd.concat(out)


def folded(text_col: str) -> Column:
    """The text without case and with single spaces between words; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s+", " "))


def copy_cluster(text_col: str) -> Column:
    """Cluster of texts that are equal but for case and white space (``pack`` with ``near`` has near copies, too)."""
    return F.xxhash64(folded(text_col))


def near_clusters(narrow: DataFrame) -> DataFrame:
    """(id, length, source, text) with ``cluster`` for the text: the SimHash component of the folded text.

    Texts that are equal but for case and white space have one fingerprint, so
    these clusters hold all exact copies. Texts are not shuffled.
    """
    rows = written(fingerprints(narrow.select(F.struct("id", "length", "source").alias("row"), folded("text").alias("text")),
                                "row", "text"), "pack-fingerprints")
    roots = written(with_roots(rows.select("fp").distinct()), "pack-clusters")
    return rows.join(roots, "fp").select("id.id", "id.length", "id.source", F.col("root").alias("cluster"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster: Column | None = None, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS,
         near: bool = False) -> DataFrame:
    """(id, piece, start, length, bin_id, bin_offset): every code point of every document in one place.

    A bin holds at most one piece of a source and one of a duplicate cluster
    (``cluster``, by default texts equal but for case and white space, with
    ``near`` the SimHash components, which hold near copies, too); null
    sources and clusters conflict with nothing. Null and empty texts are pieces
    of length 0. Repeated rows are packed each for itself and dealt to all
    shards. Other columns are not read. Bins don't depend on how the table is
    laid out.
    """
    if near and cluster is not None:
        raise ValueError("near and cluster exclude each other")
    n = df.count()
    shards = max(1, -(-n // shard_rows))
    narrow = df.select(F.col(id_col).alias("id"),
                       F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("length"),
                       F.col(source_col).alias("source"),
                       *([F.col(text_col).alias("text")] if near else
                         [(copy_cluster(text_col) if cluster is None else cluster).alias("cluster")]))
    if near:
        narrow = near_clusters(narrow)
    tasks = min(shards, max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # equal rows are counted and numbered, so that copies of one row are dealt to all shards
    same = ["id", "length", "source", "cluster"]
    runs = narrow.groupBy(*same).agg(F.count("*").alias("n")) \
        .withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long")))) \
        .repartition(tasks, *same, "first")
    dealt = runs.withColumn("copy", F.explode(F.sequence("first", F.least(F.col("first") + COPIES, F.col("n")) - 1))) \
        .select(*same, F.pmod(F.xxhash64(F.col("id").cast("string"), "length", "source", "cluster", "copy"),
                              F.lit(shards)).alias("shard"))
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType)]
                          + [T.StructField(c, T.LongType()) for c in ("piece", "start", "length", "bin_id", "bin_offset")])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pack_shard(pdf, capacity, ["id", "length", "source", "cluster"])
        return out.assign(bin_id=out["shard"] * (1 << 32) + out["bin"])[schema.names]

    return dealt.repartition(tasks, "shard").groupBy("shard").applyInPandas(run, schema).withColumnRenamed("id", id_col)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in sequences of CAPACITY code points; near copies are kept apart."""
    return pack(documents(spark, sf_dir), near=True)
