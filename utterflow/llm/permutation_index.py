"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order. It is posted, with the
first ``PREFIX`` of them, in the inverted files of its ``POSTED`` nearest pivots; a
query looks into the files of its nearest pivots. There, vectors are ranked by
the footrule distance of the two orders, in which a pivot beyond the prefix
counts as ranked just after it:

    footrule = m (m + 1) - 2 sum over shared pivots of (m - max(rank_q, rank_x)),

so the sum, the agreement, ranks them. Vectors with enough agreement are reranked by
exact inner products. How many files a query looks into, and how much agreement
is enough, is fitted on a bounded sample of queries, whose true neighbours are
found by comparing them with all vectors: directions that cluster need few files,
random ones many.

Nearness is the largest inner product of vectors of any length, so vectors get
one more component that makes their lengths equal; nearest in this space is the
largest inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import written
from .topk_search import valid

MIN_PIVOTS, MAX_PIVOTS = 32, 4096     # the number follows the root of the vectors'
PIVOT_BYTES = 64 << 20                # bound on the pivots' matrix
PREFIX = 64                           # pivots of an order that are kept
POSTED = 2                            # inverted files that a vector is in
SAMPLE = 64                           # queries that the index is fitted on
LOOKED, AGREED = 0.985, 0.985         # shares of true neighbours to be met in the files, and to agree enough there
BLOCK = 4096                          # postings handled together
SHARDS = 24                           # a small index is dealt to so many tasks all the same
QUERY_BLOCK = 4096                    # queries handled together


def padded(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones with zeros after them."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    size = np.diff(np.asarray(column.offsets))
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = flat
    return out


def nearest_chain(p: np.ndarray) -> np.ndarray:
    """An order in which each pivot is followed by the nearest one not yet taken."""
    order, left = [0] if len(p) else [], np.ones(len(p), bool)
    left[:1] = False
    while left.any():
        near = np.where(left, p @ p[order[-1]], -np.inf)
        order.append(int(near.argmax()))
        left[order[-1]] = False
    return np.array(order, dtype=int)


@dataclass
class Pivots:
    """Pivots with the component that evens lengths, and what scales vectors to them."""
    unit: float          # largest absolute entry of the table
    longest: float       # largest squared length after division by ``unit``
    dim: int
    matrix: np.ndarray = None

    def evened(self, x: np.ndarray) -> np.ndarray:
        x = x / self.unit
        return np.concatenate([x, np.sqrt(np.maximum(0.0, self.longest - (x * x).sum(1)))[:, None]], axis=1)

    def prefixes(self, x: np.ndarray) -> np.ndarray:
        """The nearest pivots of stored vectors, in order."""
        g = -(self.evened(x) @ self.matrix.T)
        m = min(PREFIX, g.shape[1])
        if g.shape[1] > 4 * m:
            near = np.sort(np.argpartition(g, m - 1, axis=1)[:, :m], axis=1)
            return np.take_along_axis(near, np.argsort(np.take_along_axis(g, near, 1), axis=1, kind="stable"), 1)
        return np.argsort(g, axis=1, kind="stable")[:, :m]

    def ranks(self, x: np.ndarray) -> np.ndarray:
        """Every pivot's rank in the order of query vectors."""
        order = np.argsort(-((x / self.unit) @ self.matrix[:, :-1].T), axis=1, kind="stable")
        out = np.empty_like(order)
        np.put_along_axis(out, order, np.arange(order.shape[1])[None, :], 1)
        return out


def agreement(rank: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """Of one query's ranks with every prefix: sum of m - max(rank_q, rank_x) over the shared pivots."""
    m = prefix.shape[1]
    weight = np.maximum(0, m - np.maximum(rank[:, None], np.arange(m)[None, :])).astype(np.uint16)
    return weight.ravel().take(prefix * m + np.arange(m)).sum(1, dtype=np.int64)


def _matrix(column: pa.Array, m: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, m).astype(np.int32)


@dataclass
class Files:
    """Where the inverted files' postings are: file after file, cut into shards of ``block`` postings."""
    count: np.ndarray            # postings of each file
    block: int
    first: np.ndarray = None     # position of each file's first posting

    def __post_init__(self):
        self.first = np.concatenate([[0], self.count.cumsum()[:-1]])

    def shard(self, pivot: np.ndarray, spread: np.ndarray) -> np.ndarray:
        return (self.first[pivot] + spread % np.maximum(1, self.count[pivot])) // self.block

    def touched(self, pivots: np.ndarray) -> np.ndarray:
        """Shards that hold postings of these files."""
        some = pivots[self.count[pivots] > 0]
        a, b = self.first[some] // self.block, (self.first[some] + self.count[some] - 1) // self.block
        n = int(b.max()) + 1 if len(b) else 0
        edge = np.zeros(n + 1, int)
        np.add.at(edge, a, 1)
        np.add.at(edge, b + 1, -1)
        return np.flatnonzero(edge.cumsum()[:n] > 0)

    def blocks_of(self, shard: np.ndarray, looks: np.ndarray, asked: int) -> np.ndarray:
        """Blocks that a shard's queries are cut into; ``looks`` counts those of the ``asked`` queries that look into each file."""
        total = np.concatenate([[0], looks.cumsum()])
        low = np.searchsorted(self.first + self.count, shard * self.block, side="right")
        high = np.searchsorted(self.first, (shard + 1) * self.block, side="left")
        return np.maximum(1, -(-np.minimum(asked, total[high] - total[np.minimum(low, high)]) // QUERY_BLOCK))


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """(h1, h2, x, asks, ids): distinct vectors with the ``k + 1`` smallest ids that have them."""
    rank = F.row_number().over(W.partitionBy("h1", "h2").orderBy("id"))
    ids = rows.select("h1", "h2", "id").distinct().withColumn("nth", rank).where(F.col("nth") <= k + 1) \
        .groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    one = rows.groupBy("h1", "h2", "x").agg(F.max("asks").alias("asks"))
    return one.join(ids, ["h1", "h2"])


def _index(nodes: DataFrame, pivots: Pivots) -> DataFrame:
    """``nodes`` with each vector's nearest pivots in order, and those whose files it is posted in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                p = pivots.prefixes(padded(part.column(2), pivots.dim)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r.tobytes() for r in p], pa.binary()),
                                                  pa.array(p[:, :POSTED].tolist(), pa.list_(pa.int32()))],
                                                 [*part.schema.names, "prefix", "posted"])

    return nodes.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in nodes.dtypes) + ", prefix binary, posted array<int>")


def _best(found: list, k: int) -> list:
    return sorted(found, key=lambda r: -r[0])[:k]


def fitted(index: DataFrame, pivots: Pivots, k: int) -> tuple[int, int]:
    """(files to look into, least agreement) for ``SAMPLE`` queries, by their true neighbours among all vectors.

    The files are those with ``LOOKED`` of the neighbours, the agreement the one
    that ``AGREED`` of these have.
    """
    asked = index.where("asks").orderBy("h2", "h1").limit(SAMPLE).select("h1", "h2", "x").collect()
    m = min(PREFIX, len(pivots.matrix))
    q = np.zeros((len(asked), pivots.dim))
    for i, r in enumerate(asked):
        q[i, :len(r.x)] = r.x
    names, sizes = [(r.h1, r.h2) for r in asked], np.array([len(r.x) for r in asked])
    ranks = pivots.ranks(q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in names]
        for b in batches:
            for at in range(0, b.num_rows, 8192):
                part = b.slice(at, 8192)
                x, p = padded(part.column(2), pivots.dim), _matrix(part.column(3), m)
                mine = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
                size = np.diff(np.asarray(part.column(2).offsets))
                for i, scores in enumerate(q @ x.T):
                    scores = np.where(size == sizes[i], scores, -np.inf)
                    top = np.argpartition(-scores, min(k, len(scores) - 1))[:k + 1]
                    top = np.array([t for t in top if mine[t] != names[i] and scores[t] > -np.inf], dtype=int)
                    looks = ranks[i][p[top, :POSTED]].min(1) if len(top) else top
                    best[i] = _best(best[i] + list(zip(scores[top].tolist(), looks.tolist(), agreement(ranks[i], p[top]).tolist(),
                                                       strict=True)), k)
        rows = [(i, *r) for i, found in enumerate(best) for r in found]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.float64(), pa.int64(), pa.int64()), strict=True)],
                                         ["q", "score", "looks", "agrees"])

    near = index.select("h1", "h2", "x", "prefix").mapInArrow(run, "q int, score double, looks long, agrees long")
    true = near.withColumn("nth", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score")))).where(F.col("nth") <= k).collect()
    if not true:
        return len(pivots.matrix), 0
    looks, agrees = np.array([r.looks for r in true]), np.array([r.agrees for r in true])
    files = int(np.sort(looks)[min(len(looks) - 1, int(LOOKED * len(looks)))]) + 1
    met = np.sort(agrees[looks < files])
    return files, int(met[int((1 - AGREED) * len(met))])


def search_shard(q: dict, x: dict, pivots: Pivots, files: int, least: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, postings, scores): the k best of the postings that each query has to rerank.

    A vector and a query that meet in several files meet for the query's nearest
    of them only.
    """
    m = x["prefix"].shape[1]
    flat = x["prefix"] * m + np.arange(m, dtype=np.int32)
    firsts = x["prefix"][:, :POSTED]
    for i, rank in enumerate(pivots.ranks(q["x"])):
        here = rank[x["pivot"]]
        met = np.flatnonzero((here < files) & (here == rank[firsts].min(1)) & (x["size"] == q["size"][i]))
        if not len(met):
            continue
        weight = np.maximum(0, m - np.maximum(rank[:, None], np.arange(m)[None, :])).astype(np.uint16)
        agrees = weight.ravel().take(flat[met]).sum(1, dtype=np.int32)
        enough = min(least, int(np.partition(agrees, len(agrees) - k)[len(agrees) - k])) if len(agrees) > k else 0
        met = met[agrees >= enough]
        score = np.einsum("ij,j->i", x["x"][met], q["x"][i])
        if len(met) > k:
            kept = score >= np.partition(score, len(score) - k)[len(score) - k]
            met, score = met[kept], score[kept]
        by = np.lexsort((x["low"][met], -score))[:k]
        yield i, met[by], score[by]


def _search(index: DataFrame, asked: DataFrame, pivots: Pivots, files: int, least: int, counts: Files, k: int) -> DataFrame:
    """(q1, q2, hits): at most ``k + 1`` hits (-score, id, own) of each asked vector, nearest first."""
    dim, m, p = pivots.dim, min(PREFIX, len(pivots.matrix)), len(pivots.matrix)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(p, np.int64)
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                n += (pivots.ranks(padded(b.column(0).slice(i, 2048), dim)) < files).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p)), pa.array(n)], ["pivot", "n"])

    looks = np.zeros(p, np.int64)
    for r in asked.select("x").mapInArrow(look, "pivot long, n long").groupBy("pivot").agg(F.sum("n").alias("n")).collect():
        looks[r["pivot"]] = r["n"]
    number = int(looks.sum()) // files               # of the queries: each looks into so many files

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pivot = _matrix(b.column(4), m)[:, :POSTED]
            at = np.repeat(np.arange(len(pivot)), pivot.shape[1])
            pivot = pivot.ravel()
            shard = counts.shard(pivot, b.column(0).to_numpy().view(np.uint64)[at] >> np.uint64(1))
            rows = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(counts.blocks_of(shard, looks, number), pa.int64()),
                                              pa.array(pivot, pa.int32()), *rows.columns],
                                             ["shard", "blocks", "pivot", *rows.schema.names])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                rank = pivots.ranks(padded(part.column(2), dim))
                to = [counts.touched(np.flatnonzero(r < files)) for r in rank]
                rows = part.take(pa.array(np.repeat(np.arange(len(to)), [len(t) for t in to])))
                shard = np.concatenate(to)
                block = (rows.column(1).to_numpy().view(np.uint64) % counts.blocks_of(shard, looks, number).astype(np.uint64)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(block), *rows.columns],
                                                 ["shard", "block", *rows.schema.names])

    kind = dict(index.dtypes)["x"]
    posted = index.select("h1", "h2", "x", "ids", "prefix") \
        .mapInArrow(post, f"shard long, blocks long, pivot int, h1 long, h2 long, x {kind}, ids array<long>, prefix binary") \
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).drop("blocks")
    routed = asked.select("h1", "h2", "x").mapInArrow(route, f"shard long, block long, h1 long, h2 long, x {kind}")
    names = ["q1", "q2", "score", "low", "ids", "own"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.bool_()]

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], t) for t in kinds], names)
        if not left.num_rows or not right.num_rows:
            return none
        left, right = left.combine_chunks(), right.combine_chunks()
        one = {c: left[c].combine_chunks() for c in ("x", "ids", "prefix", "h1", "h2", "pivot")}
        asks = right["x"].combine_chunks()
        low = np.asarray(one["ids"].flatten())[np.asarray(one["ids"].offsets)[:-1] - one["ids"].offsets[0].as_py()]
        x = {"x": padded(one["x"], dim), "size": np.diff(np.asarray(one["x"].offsets)), "pivot": one["pivot"].to_numpy(),
             "prefix": _matrix(one["prefix"], m), "low": low}
        q = {"x": padded(asks, dim), "size": np.diff(np.asarray(asks.offsets))}
        h, qh = (np.stack([t["h1"].to_numpy(), t["h2"].to_numpy()], 1) for t in (left, right))
        which, at, scores = [], [], []
        for i, found, score in search_shard(q, x, pivots, files, least, k + 1):
            which += [i] * len(found)
            at += found.tolist()
            scores += score.tolist()
        if not at:
            return none
        which, at = np.array(which), np.array(at)
        own = (h[at] == qh[which]).all(1)
        return pa.table([pa.array(qh[which, 0]), pa.array(qh[which, 1]), pa.array(scores, pa.float64()), pa.array(low[at]),
                         one["ids"].take(pa.array(at)), pa.array(own)], names)

    near = posted.groupBy("shard", "block").cogroup(routed.groupBy("shard", "block")).applyInArrow(
        answer, "q1 long, q2 long, score double, low long, ids array<long>, own boolean")
    rank = F.row_number().over(W.partitionBy("q1", "q2").orderBy(F.desc("score"), "low"))
    hits = F.flatten(F.transform("found", lambda n: F.transform(n.ids, lambda i: F.struct(
        (-n.score).alias("minus"), i.alias("id"), n.own.alias("own")))))
    return near.withColumn("nth", rank).where(F.col("nth") <= k + 1).groupBy("q1", "q2") \
        .agg(F.collect_list(F.struct("score", "ids", "own")).alias("found")) \
        .select("q1", "q2", F.slice(F.sort_array(hits), 1, k + 1).alias("hits"))


def nearest(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` vectors found with the largest inner products, per query row.

    ``queries`` is a condition on the columns of ``df``; all other rows are
    candidates, ties go to the smaller id. Scores are inner products in double
    precision. Equal vectors are one posting, with the ``k + 1`` smallest of their
    ids, and one query. A query for which the index finds fewer than ``k`` is
    compared with all vectors of its length.
    Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without an id, take no part; vectors of different lengths are never
    compared; rows with one id are queries and candidates each if their vectors
    differ, else one of them; other columns are not read.
    """
    spark = df.sparkSession
    element = df.schema[vec_col].dataType.elementType.simpleString()
    kind = element if element in ("float", "double") else "double"
    # adding zero makes -0.0 and 0.0 equal
    rows = df.where(F.col(id_col).isNotNull() & valid(vec_col) & F.exists(vec_col, lambda v: v != 0)) \
        .select(F.col(id_col).cast("long").alias("id"), F.transform(vec_col, lambda v: v.cast(kind) + F.lit(0).cast(kind)).alias("x"),
                F.coalesce(queries, F.lit(False)).alias("asks")) \
        .withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(1), "x")})
    nodes = written(_nodes(rows, k), "distinct-vectors")
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = nodes.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("x", F.abs)).cast("double")).alias("unit"),
                     F.max(F.size("x")).alias("dim"), F.coalesce(F.max("asks"), F.lit(False)).alias("asks")).first()
    if not size["asks"]:
        return none
    square = F.aggregate("x", F.lit(0.0), lambda s, v: s + (v / F.lit(size["unit"])) * (v / F.lit(size["unit"])))
    pivots = Pivots(size["unit"], nodes.agg(F.max(square)).first()[0], size["dim"])
    some = max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * pivots.dim), max(MIN_PIVOTS, int(size["n"] ** 0.5))))
    x = padded(pa.array([r.x for r in nodes.orderBy("h1", "h2").limit(some).select("x").collect()], pa.list_(pa.float64())), pivots.dim)
    x = pivots.evened(x)
    pivots.matrix = x[nearest_chain(x)]

    index = written(_index(nodes, pivots), "permutations")
    files, least = fitted(index, pivots, k)
    count = np.zeros(len(pivots.matrix), np.int64)
    for r in index.select(F.explode("posted").alias("pivot")).groupBy("pivot").count().collect():
        count[r["pivot"]] = r["count"]
    counts = Files(count, max(1, min(BLOCK, -(-int(count.sum()) // SHARDS))))
    found = written(_search(index, index.where("asks"), pivots, files, least, counts, k), "neighbours")

    lengths = rows.select("h1", "h2", "id", F.size("x").alias("dim")).distinct().groupBy("dim").agg(F.count("*").alias("rows"))
    held = found.select("q1", "q2", F.size("hits").alias("n"))
    short = index.where("asks").withColumn("dim", F.size("x")).join(lengths, "dim") \
        .join(held, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")), "left") \
        .where(F.coalesce("n", F.lit(0)) < F.least(F.lit(k + 1), "rows")).select(*index.columns)
    short = written(short, "short")
    if short.limit(1).count():
        again = _search(index, short, pivots, len(pivots.matrix), 0, counts, k)
        found = found.join(short.select(F.col("h1").alias("q1"), F.col("h2").alias("q2")), ["q1", "q2"], "left_anti").union(again)
    mine = rows.where("asks").select("id", "h1", "h2").distinct() \
        .join(found, (F.col("h1") == F.col("q1")) & (F.col("h2") == F.col("q2")))
    others = F.slice(F.filter("hits", lambda r: ~(r.own & (r.id == F.col("id")))), 1, k)
    return mine.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit")) \
        .select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def op12_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty nearest vectors found for every vector whose id is divisible by 20."""
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
