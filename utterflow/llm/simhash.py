"""SimHash near-duplicate detection.

A fingerprint maps to the bit counts of its 32 two-bit segments. The Manhattan
distance of two such count vectors never exceeds the Hamming distance of the
fingerprints, and if it is at most three, one half of the vector (16 segments)
differs by at most one. So a grid over each half, joined with its own cell and
the cells one step up an axis, meets every pair; the exact bit distance then
decides. Equal fingerprints are one node, so a node has at most
C(64,1)+C(64,2)+C(64,3) links however large a group of copies is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, documents, small_batches, written

_RUN = 255                       # rows whose bits can be summed in one byte
_PAIRS = 0x55555555              # the low bit of each two-bit segment


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of the word shingles of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(joined, 42)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[:len(words) - shingle]]
        hashes = [digest(joined[a:b - 1], 42) for a, b in zip(starts, ends[shingle - 1:], strict=True)]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 64 * _RUN):
        bits = np.unpackbits(h[i:i + 64 * _RUN].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // _RUN * _RUN
        ones += bits[:full].reshape(-1, _RUN, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[full:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, fp long) per row; null text counts as empty."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def near_pairs(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in at most ``max_bits`` (<= 3) bits.

    ``fps`` has one row per distinct fingerprint, in column ``fp``. A pair may
    come twice, once from each half of the grid.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the half-vector grid is exact for up to 3 bits")
    bits = fps.select("fp", F.posexplode(F.array(
        F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32))).alias("half", "bits"))
    half = bits.select("fp", "half", (F.col("bits").bitwiseAND(F.lit(_PAIRS))
                                      + F.shiftrightunsigned("bits", 1).bitwiseAND(F.lit(_PAIRS))).alias("cell"))
    home = half.select("half", "cell", F.col("fp").alias("b"))
    step = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("s")
    up = half.select("half", "cell", "fp", step) \
        .where("shiftrightunsigned(cell, 2 * s) & 3 < 2") \
        .select("half", F.expr("cell + shiftleft(1L, 2 * s)").alias("cell"), F.col("fp").alias("a"), F.lit(1).alias("up"))
    probe = half.select("half", "cell", F.col("fp").alias("a"), F.lit(0).alias("up")).union(up)
    return probe.join(home, ["half", "cell"]) \
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits) \
        .where("up = 1 or a < b").select("a", "b")


def with_roots(nodes: DataFrame, max_bits: int = 3) -> DataFrame:
    """``nodes`` (one row per distinct ``fp``) and ``root``, the smallest fingerprint of the component."""
    roots = connected_components(near_pairs(nodes.select("fp"), max_bits))
    return nodes.join(roots, F.col("fp") == F.col("node"), "left") \
        .select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(id, fp, component_id) per row of ``df``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` bits. Null and empty texts have fingerprint 0 and are linked
    like any other; null ids are never a component's id (null only if the whole
    component has none); repeated rows stay, each with its result; other
    columns of ``df`` are not read.
    """
    docs = written(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    nodes = docs.groupBy("fp").agg(F.min("id").alias("first"))
    rooted = with_roots(nodes, max_bits)
    # written, so that each join below has two plain exchanges and AQE can split a component or a
    # fingerprint that holds a large share of the rows
    smallest = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "components")
    labels = written(rooted.join(smallest, "root").select("fp", "component_id"), "labels")
    return docs.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_groups(documents(spark, sf_dir)) \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
