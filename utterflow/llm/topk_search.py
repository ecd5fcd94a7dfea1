"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; of each its mean and deviation are kept, for
coarse and for fine segments. By Cauchy-Schwarz within every segment,

    |q - x|^2 >= sum_s  n_s * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),

which with the exact squared lengths bounds the inner product from above.

A bounded sample of vectors gives every query a first threshold. Vectors are
dealt to cells (nearest of a bounded set of pivots) and cells into blocks, whose
statistics span boxes; a pair of a query block and a vector block is formed only
if some query's bound with the box reaches its threshold. In a pair vectors are
filtered from coarse to fine against each query's k-th best score so far; only
survivors get exact scores, and k rows a query leave it.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import written

QUERY_BLOCK, QUERY_BYTES = 16384, 8 << 20      # queries held together, and bound on their size
VECTOR_BLOCK, VECTOR_BYTES = 8192, 4 << 20     # vectors filtered together, likewise
PIVOTS = 256                     # bound on the pivots that cells are made from
SAMPLE = 2048                    # vectors that give the first thresholds
BOXES = 4096                     # boxes that a query block is compared with at once
EXACT = 2.0 ** 53                # integers below it are exact in double precision
LEVELS = (1, 4, 16)              # numbers of segments, coarse to fine
DENSE = 0.05                     # above this share of survivors a level is one matrix product, else pair by pair


def segment_bounds(dim: int, n: int) -> list[tuple[int, int]]:
    """At most ``n`` contiguous segments of nearly equal length that cover ``dim`` components."""
    edges = np.linspace(0, dim, min(n, max(dim, 1)) + 1).astype(int)
    return [(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a]


def statistics(x: np.ndarray, n: int) -> np.ndarray:
    """Segment means and deviations, scaled by the square root of the segment's length."""
    cols = []
    for a, b in segment_bounds(x.shape[1], n):
        part = x[:, a:b]
        cols += [part.mean(1) * np.sqrt(b - a), part.std(1) * np.sqrt(b - a)]
    return np.stack(cols, axis=1) if cols else np.zeros((len(x), 1))


class Block:
    """Integer vectors with exact squared lengths and the statistics of every level."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray):
        self.rows, self.ids, self.x = rows, ids, x
        self.squares = (x * x).sum(1)
        self.levels = [statistics(x, n) for n in LEVELS]

    def box(self) -> np.ndarray:
        """Least and greatest of every statistic, and the greatest squared length."""
        s = np.concatenate(self.levels, axis=1)
        return np.concatenate([s.min(0), s.max(0), [self.squares.max()]])


def box_bounds(q: Block, boxes: np.ndarray) -> np.ndarray:
    """Upper bounds of every query's inner products with the vectors of each box."""
    width = [x.shape[1] for x in q.levels]
    total, out = sum(width), np.full((len(q.ids), len(boxes)), np.inf)
    at = 0
    for level, n in zip(q.levels, width, strict=True):
        low, high = boxes[:, at:at + n], boxes[:, total + at:total + at + n]
        for i in range(0, len(out), rows := max(1, (1 << 22) // max(1, len(boxes) * n))):
            part = level[i:i + rows, None, :]
            away = np.maximum(0.0, np.maximum(low[None] - part, part - high[None]))
            bound = 0.5 * (q.squares[i:i + rows, None] + boxes[None, :, -1] - (away * away).sum(2))
            np.minimum(out[i:i + rows], bound, out=out[i:i + rows])
        at += n
    return out


def upper_bounds(q: Block, i: np.ndarray, x: Block, j: np.ndarray, level: int) -> np.ndarray:
    """Upper bounds of the inner products of query rows ``i`` with vector rows ``j`` (pairwise)."""
    d = q.levels[level][i] - x.levels[level][j]
    return 0.5 * (q.squares[i] + x.squares[j] - (d * d).sum(1))


def slack(*blocks: Block) -> float:
    """What rounding can take from a bound."""
    return 1e-9 * (1.0 + sum(b.squares.max(initial=0.0) for b in blocks))


def thresholds(q: Block, sample: Block, k: int) -> np.ndarray:
    """Every query's k-th best score among the sample, itself left out; minus infinity where there are fewer."""
    score = q.x @ sample.x.T
    score[q.rows[:, None] == sample.rows[None, :]] = -np.inf
    if score.shape[1] < k:
        return np.full(len(q.ids), -np.inf)
    return np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]


def search_large(q: Block, x: Block, best: list[list[tuple[int, int]]], k: int) -> None:
    """``search_block`` in Python's integers, for scores that may not be exact in double precision."""
    vectors = [[int(c) for c in v] for v in x.x]
    for i, v in enumerate(q.x):
        mine = [int(c) for c in v]
        found = [(-sum(a * b for a, b in zip(mine, other, strict=True)), int(x.ids[j]))
                 for j, other in enumerate(vectors) if x.rows[j] != q.rows[i]]
        best[i] = sorted(best[i] + found)[:k]


def search_block(q: Block, x: Block, best: list[list[tuple[float, int]]], k: int, least: np.ndarray | None = None) -> None:
    """Merge the k best of ``x`` into ``best``, per query a list of (-score, id) in rank order.

    ``least`` is a score that each query's k-th best is known to reach. Scores
    are sums of integers below 2**53 in double precision, so they are exact;
    where they may be larger, all pairs are scored in Python's integers.
    """
    if q.squares.max(initial=0.0) * x.squares.max(initial=0.0) >= EXACT ** 2:
        search_large(q, x, best, k)
        return
    rows = max(1, (1 << 22) // max(1, len(x.ids)))
    order = np.lexsort((x.ids, -x.squares))           # long vectors first: good thresholds early
    seed = order[:max(4 * k, 64)]
    for at in range(0, len(q.ids), rows):
        mine = np.arange(at, min(at + rows, len(q.ids)))
        # thresholds from a few exact scores
        first = q.x[mine] @ x.x[seed].T
        first[q.rows[mine][:, None] == x.rows[seed][None, :]] = -np.inf
        floor = np.full(len(mine), -np.inf)
        if first.shape[1] >= k:
            floor = np.partition(first, first.shape[1] - k, axis=1)[:, first.shape[1] - k]
        known = np.array([-best[i][k - 1][0] if len(best[i]) >= k else -np.inf for i in mine])
        floor = np.maximum(floor, known)
        if least is not None:
            floor = np.maximum(floor, least[mine])
        floor = floor - slack(q, x)
        i, j = None, None                # None: all pairs of the chunk
        for level in range(len(LEVELS)):
            if i is None or len(i) > DENSE * len(mine) * len(x.ids):
                passed = q.levels[level][mine] @ x.levels[level].T
                passed += 0.5 * (q.squares[mine] - (q.levels[level][mine] ** 2).sum(1))[:, None]
                passed += 0.5 * (x.squares - (x.levels[level] ** 2).sum(1))[None, :]
                passed = passed >= floor[:, None]
                if i is None:
                    i, j = np.nonzero(passed)
                else:
                    keep = passed[i, j]
                    i, j = i[keep], j[keep]
            else:
                keep = np.concatenate([upper_bounds(q, mine[i[s]], x, j[s], level) >= floor[i[s]]
                                       for s in _slices(len(i))] or [np.zeros(0, bool)])
                i, j = i[keep], j[keep]
        if len(i) > DENSE * len(mine) * len(x.ids):
            score = (q.x[mine] @ x.x.T)[i, j]
        else:
            score = np.concatenate([np.einsum("ij,ij->i", q.x[mine[i[s]]], x.x[j[s]]) for s in _slices(len(i))]
                                   or [np.zeros(0)])
        other = q.rows[mine[i]] != x.rows[j]
        i, j, score = i[other], j[other], score[other]
        by = np.lexsort((x.ids[j], -score, i))
        i, j, score = i[by], j[by], score[by]
        start = np.searchsorted(i, np.arange(len(mine)))
        end = np.searchsorted(i, np.arange(len(mine)), side="right")
        for row in range(len(mine)):
            a, b = start[row], min(end[row], start[row] + k)
            if b > a:
                found = list(zip((-score[a:b]).tolist(), x.ids[j[a:b]].tolist(), strict=True))
                best[mine[row]] = sorted(best[mine[row]] + found)[:k]


def _slices(n: int, step: int = 1 << 18):
    return [slice(a, a + step) for a in range(0, n, step)]


def valid(c: str):
    """Vectors without null or non-finite components (null vectors: false)."""
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col(c).isNotNull() & ~bad, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(-1, dim)


def block_rows(rows: int, size: int, dim: int) -> int:
    """Rows of a block: at most ``rows``, and ``size`` bytes."""
    return max(1, min(rows, size // (8 * max(1, dim))))


def packed_blocks(df: DataFrame, blocks: int, dim: int) -> DataFrame:
    """(block, rows, ids, x, box): the rows (row, id, x) of each block as bytes; ``df`` has the block."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy()).astype(np.float64).reshape(len(pdf), dim)
        b = Block(pdf["row"].to_numpy(np.int64), pdf["id"].to_numpy(np.int64), x)
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "rows": [b.rows.tobytes()], "ids": [b.ids.tobytes()],
                             "x": [x.tobytes()], "box": [b.box().tobytes()]})

    tasks = max(1, min(blocks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return df.repartition(tasks, "block").groupBy("block") \
        .applyInPandas(run, "block int, rows binary, ids binary, x binary, box binary")


def unpacked(rows: bytes, ids: bytes, x: bytes, dim: int) -> Block:
    return Block(np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(x, np.float64).reshape(-1, dim))


def integers(vec_col: str, scale: int):
    """floor(scale * component) in double precision, whatever its size."""
    def one(v):
        y = F.lit(float(scale)) * v.cast("double")
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)     # above, every double is an integer
    return F.transform(vec_col, one)


def top_k(df: DataFrame, queries, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query row's ``k`` highest integer inner products.

    ``queries`` is a condition on the columns of ``df``. Components are
    floor(scale * x). All other rows are candidates; ties go to the smaller id.
    Vectors that are null, empty, or hold null or non-finite components, and
    rows without an id, take no part; vectors of different lengths are never
    compared; of rows with one id and one vector one takes part; rows with one id
    and different vectors are rows, and queries, each; other columns are not
    read. Scores are exact and ranked whatever their size; one that does not fit
    in a long is null. Squared lengths from 1e37 on are an error.
    """
    square = F.expr("aggregate(x, 0D, (s, v) -> s + v * v)")
    rows = df.where(F.col(id_col).isNotNull() & valid(vec_col) & (F.size(vec_col) > 0)) \
        .select(F.col(id_col).cast("long").alias("id"), integers(vec_col, scale).alias("x"), F.coalesce(queries, F.lit(False)).alias("asks")) \
        .distinct().withColumn("row", F.monotonically_increasing_id()).withColumn("large", square >= EXACT)
    rows = written(rows, "vectors")
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n"), F.max(square).alias("longest"))
    out = None
    for s in sizes.collect():              # one pass for each vector length in the table
        if s["longest"] >= 1e37:
            raise ValueError("squared lengths from 1e37 on")
        part = _top_k_of(rows.where(F.size("x") == s["dim"]), s["dim"], k)
        out = part if out is None else out.union(part)
    if out is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out


def _cells(rows: DataFrame, dim: int, n: int) -> DataFrame:
    """``rows`` (row, id, x) with a block: cut from the cell of the nearest pivot, a hash of the row within it."""
    per = block_rows(VECTOR_BLOCK, VECTOR_BYTES, dim)
    found = rows.orderBy(F.xxhash64("x", F.lit("pivot")), "row").limit(max(1, min(PIVOTS, -(-n // per)))).select("x").collect()
    pivots = np.array([r.x for r in found], dtype=np.float64).reshape(-1, dim)
    half = 0.5 * (pivots * pivots).sum(1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = (_matrix(b.column(2), dim) @ pivots.T - half).argmax(1) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], ["row", "id", "x", "cell"])

    celled = written(rows.select("row", "id", "x").mapInArrow(assign, "row long, id long, x array<double>, cell int"), "cells")
    first, plan = 0, []
    for c in celled.groupBy("cell").count().orderBy("cell").collect():           # at most PIVOTS rows
        plan.append((c["cell"], first, -(-c["count"] // per)))
        first += plan[-1][2]
    plan = df_plan(rows.sparkSession, plan)
    return celled.join(F.broadcast(plan), "cell").select(
        "row", "id", "x", (F.col("first") + F.pmod(F.xxhash64("row", F.lit("block")), F.col("parts"))).cast("int").alias("block"))


def df_plan(spark: SparkSession, plan: list[tuple[int, int, int]]) -> DataFrame:
    return spark.createDataFrame(plan, "cell int, first int, parts int")


def block_pairs(asks: DataFrame, boxes: DataFrame, dim: int) -> DataFrame:
    """(q_block, block) of the pairs in which some query's bound reaches its threshold.

    Boxes are compared ``BOXES`` at a time: each query block meets each chunk of boxes.
    """
    chunks = boxes.groupBy(F.expr(f"block div {BOXES}").cast("int").alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("block", "box"))).alias("boxes"))
    n = chunks.count()
    wide = asks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(max(0, n - 1)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q_block, rows, ids, x, least, some in zip(*(c.to_pylist() for c in b.columns), strict=True):
                q, least = unpacked(rows, ids, x, dim), np.frombuffer(least)
                box = np.stack([np.frombuffer(r["box"]) for r in some])
                bound = box_bounds(q, box)
                room = 1e-9 * (1.0 + q.squares.max() + box[:, -1])
                near = (bound >= least[:, None] - room[None, :]).any(0)
                at = [r["block"] for r, keep in zip(some, near, strict=True) if keep]
                yield pa.RecordBatch.from_arrays([pa.array([q_block] * len(at), pa.int32()), pa.array(at, pa.int32())], ["q_block", "block"])

    return wide.join(chunks, "chunk").select("q_block", "q_rows", "q_ids", "q_x", "least", "boxes") \
        .mapInArrow(run, "q_block int, block int")


def _top_k_of(rows: DataFrame, dim: int, k: int) -> DataFrame:
    spark = rows.sparkSession
    n = {r["large"]: r for r in rows.groupBy("large").agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("nq")).collect()}
    small, n_small = rows.where("not large"), n[False]["n"] if False in n else 0
    taken = small.orderBy(F.xxhash64("row", F.lit("sample"))).limit(SAMPLE).select("row", "id", "x").collect() if n_small else []
    sample = Block(np.array([r.row for r in taken], np.int64), np.array([r.id for r in taken], np.int64),
                   np.array([r.x for r in taken], dtype=np.float64).reshape(-1, dim))

    # query blocks with first thresholds; large queries have blocks of their own, and no threshold
    per, parts, first = block_rows(QUERY_BLOCK, QUERY_BYTES, dim), [], 0
    for large, r in sorted(n.items()):
        if r["nq"]:
            blocks = -(-r["nq"] // per)
            parts.append(rows.where(F.col("asks") & (F.col("large") == large)).select(
                "row", "id", "x", (first + F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks))).cast("int").alias("block")))
            first += blocks
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = parts[0] if len(parts) == 1 else parts[0].union(parts[1])

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            least = []
            for rows, ids, x in zip(*(b.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                q = unpacked(rows, ids, x, dim)
                known = q.squares.max() < EXACT and len(sample.ids)
                least.append((thresholds(q, sample, k) if known else np.full(len(q.ids), -np.inf)).tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(least, pa.binary())], ["q_block", "q_rows", "q_ids", "q_x", "least"])

    asks = written(packed_blocks(queries, first, dim).mapInArrow(
        begin, "q_block int, q_rows binary, q_ids binary, q_x binary, least binary"), "query-blocks")

    # vector blocks; large vectors have blocks of their own, which are compared with every query
    per_vector = block_rows(VECTOR_BLOCK, VECTOR_BYTES, dim)
    pairs = vectors = None
    if n_small:
        vectors = written(packed_blocks(_cells(small, dim, n_small), -(-n_small // per_vector) + PIVOTS, dim), "vector-blocks")
        pairs = block_pairs(asks, vectors.select("block", "box"), dim)
    if True in n:
        blocks = -(-n[True]["n"] // per_vector)
        big = rows.where("large").select("row", "id", "x", (-1 - F.pmod(F.xxhash64("row"), F.lit(blocks))).cast("int").alias("block"))
        big = written(packed_blocks(big, blocks, dim), "large-blocks")
        all_big = asks.select("q_block", F.explode(F.sequence(F.lit(-blocks), F.lit(-1))).alias("block"))
        vectors, pairs = (big, all_big) if vectors is None else (vectors.union(big), pairs.union(all_big))
    pairs = written(pairs, "block-pairs")
    # both blocks of a pair meet under the pair's own key, so pairs spread over tasks however few query blocks there are
    tasks = max(1, min(2 * pairs.count(), 10_000))
    mine = pairs.join(asks, "q_block").repartition(tasks, "q_block", "block")
    other = pairs.join(vectors.select("block", "rows", "ids", "x"), "block").repartition(tasks, "q_block", "block")
    both = mine.join(other, ["q_block", "block"])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for q_rows, q_ids, q_x, least, rows, ids, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                q = unpacked(q_rows, q_ids, q_x, dim)
                best = [[] for _ in q.ids]
                search_block(q, unpacked(rows, ids, x, dim), best, k, np.frombuffer(least))
                out = [(int(q.rows[i]), int(q.ids[i]), v, Decimal(-int(s))) for i, found in enumerate(best) for s, v in found]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)],
                                                 ["q_row", "query_id", "vec_id", "exact"])

    near = both.select("q_rows", "q_ids", "q_x", "least", "rows", "ids", "x") \
        .mapInArrow(run, "q_row long, query_id long, vec_id long, exact decimal(38,0)")
    rank = F.row_number().over(W.partitionBy("q_row").orderBy(F.desc("exact"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", F.expr("try_cast(exact AS bigint)").alias("score"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best of all vectors for every vector whose id is divisible by 100."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
