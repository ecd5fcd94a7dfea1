"""Embedding near-duplicates: exact pairs by cosine from dual traversal of cover trees.

Vectors are scaled to length one, so cosine >= t is Euclidean distance <=
eps = sqrt(2 - 2t). Equal vectors are one node first. Nodes are dealt to cells
(nearest of a bounded set of pivots) and cells into blocks; cells further apart
than their covering radii plus eps are never paired. Every block has a cover
tree with nested levels whose radii halve from one that covers the sphere down to
eps, eps/2, eps/4 ... and points; two trees are traversed together from their
roots, dropping node pairs whose centres are further apart than both covering
radii plus eps, and taking node pairs as linked whole whose centres and radii
together stay within eps. A pair of blocks returns link counts and a spanning
forest, never all pairs of a dense group.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import connected_components, written

BLOCK, BLOCK_BYTES = 16384, 16 << 20     # vectors in a block (on average), and bound on their size
PIVOTS = 2048                    # bound on the pivots that cells are made from
LEVELS = 4                       # radii eps, eps/2, ... and then the points; above them eps doubles up to the sphere's
SLACK = 1e-4                     # for single precision in bounds; links are verified in double precision
CHUNK_BYTES = 64 << 20           # of the vectors of node pairs expanded together


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _distance(cosine):
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _cover(u: np.ndarray, rows: np.ndarray, radius: float) -> list[tuple[np.ndarray, float]]:
    """Greedy cover of ``rows``: groups led by their centre, which is further than ``radius`` from earlier centres."""
    out, m = [], u[rows]
    while len(rows):
        g = m @ m[:512].T
        open_ = np.ones(len(rows), bool)
        for j in range(g.shape[1]):
            if open_[j]:
                d = _distance(g[:, j])
                inside = open_ & (d <= radius)
                inside[j] = True
                mine = np.flatnonzero(inside)
                open_[mine] = False
                mine = np.concatenate([[j], mine[mine != j]])
                out.append((rows[mine], float(d[mine[1:]].max(initial=0.0))))
        rows, m = rows[open_], m[open_]
    return out


class CoverTree:
    """Nested levels over unit vectors; a node is a range of ``order`` that begins with its centre."""

    def __init__(self, u: np.ndarray, eps: float):
        order = np.arange(len(u))
        spans = [(0, len(u))] if len(u) else []
        self.levels = []                     # (start, end, radius) of every node, by start
        for level in range(-self.above(eps), LEVELS):
            nodes, radius = [], []
            for a, b in spans:
                if b - a == 1:
                    nodes.append((a, b))
                    radius.append(0.0)
                    continue
                at = a
                for rows, r in _cover(u, order[a:b].copy(), eps * 2.0 ** -level):
                    order[at:at + len(rows)] = rows
                    nodes.append((at, at + len(rows)))
                    radius.append(r)
                    at += len(rows)
            spans = nodes
            self.levels.append(self._level(nodes, radius))
        points = np.arange(len(u))
        self.levels.append((points, points + 1, np.zeros(len(u))))
        self.order = order

    @staticmethod
    def above(eps: float) -> int:
        """Levels above eps: the radius of the highest is at least 1, so it has few nodes."""
        return max(0, math.ceil(math.log2(1 / eps))) if eps > 1e-6 else 0

    @staticmethod
    def _level(nodes, radius):
        n = np.array(nodes, dtype=np.int64).reshape(-1, 2)
        return n[:, 0], n[:, 1], np.array(radius, dtype=float)


def absorb(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of ``i`` and ``j`` pairwise; labels stay fully resolved, the smallest wins."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


class Join:
    """Dual traversal of two trees (or of one with itself)."""

    def __init__(self, a: dict, b: dict, cosine: float, same: bool):
        self.t, self.same = cosine, same
        self.eps = math.sqrt(max(0.0, 2 - 2 * cosine))
        self.ta, self.tb = a["tree"], b["tree"]
        self.xa, self.xb = a["x"][self.ta.order].astype(np.float64), b["x"][self.tb.order].astype(np.float64)
        self.ua, self.ub = unit(self.xa), unit(self.xb)
        self.na, self.nb = a["n"][self.ta.order], b["n"][self.tb.order]
        self.ca, self.cb = np.concatenate([[0], self.na.cumsum()]), np.concatenate([[0], self.nb.cumsum()])
        self.wa = np.zeros(len(self.na), np.int64)
        self.wb = self.wa if same else np.zeros(len(self.nb), np.int64)
        self.shift = 0 if same else len(self.na)
        self.label = np.arange(self.shift + len(self.nb))

    def run(self) -> None:
        (sa, _, _), (sb, _, _) = self.ta.levels[0], self.tb.levels[0]
        if not len(sa) or not len(sb):
            return
        self.above, self.last = CoverTree.above(self.eps), len(self.ta.levels) - 1
        self.fa, self.fb = self.ua.astype(np.float32), self.ub.astype(np.float32)
        self.chunk = max(1 << 12, CHUNK_BYTES // (16 * max(1, self.ua.shape[1])))
        self._dense(0, 0, len(sa), 0, len(sb), self.same)

    def _dense(self, level: int, a: int, ea: int, b: int, eb: int, mirrored: bool) -> None:
        """All pairs of the nodes [a, ea) and [b, eb) of a level: a matrix product at a time, then the bound of each pair."""
        (sa, _, ra), (sb, _, rb) = self.ta.levels[level], self.tb.levels[level]
        reach = self.eps + SLACK
        wide = np.flatnonzero(rb[b:eb] > 0)              # points need no bound of their own
        for at in range(a, ea, 512):
            mine = ra[at:min(at + 512, ea), None]
            g = self.fa[sa[at:at + len(mine)]] @ self.fb[sb[b:eb]].T + 1e-5
            near = g >= (1 - np.minimum(2.0, mine + reach) ** 2 / 2).astype(np.float32)
            if len(wide):
                bound = 1 - np.minimum(2.0, mine + (rb[b:eb][wide] + reach)[None, :]) ** 2 / 2
                near[:, wide] = g[:, wide] >= bound.astype(np.float32)
            i, j = np.nonzero(near)
            i, j = i + at, j + b
            if mirrored:
                i, j = i[j >= i], j[j >= i]
            for k in range(0, len(i), self.chunk):
                self._descend(level, i[k:k + self.chunk], j[k:k + self.chunk])

    def _descend(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """Node pairs of one level: prune, take whole, or expand to the next level."""
        (sa, ea, ra), (sb, eb, rb) = self.ta.levels[level], self.tb.levels[level]
        if level == self.last:
            if self.same:
                i, j = i[i < j], j[i < j]
            self._link(i, j)
            return
        d = _distance(np.einsum("ij,ij->i", self.ua[sa[i]], self.ub[sb[j]]))
        reach = ra[i] + rb[j]
        near = d <= reach + self.eps + SLACK
        i, j, d, reach = i[near], j[near], d[near], reach[near]
        single = (ea[i] - sa[i] == 1) & (eb[j] - sb[j] == 1)
        self._descend(self.last, sa[i[single]], sb[j[single]])
        whole = ~single & (d + reach <= self.eps - SLACK)
        self._take(sa[i[whole]], ea[i[whole]], sb[j[whole]], eb[j[whole]])
        rest = ~single & ~whole
        if level < self.above:
            self._expand_dense(level, i[rest], j[rest])
        else:
            self._expand(level, i[rest], j[rest])

    def _expand_dense(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """The few node pairs of an upper level have many children: pair by pair; small ones together."""
        (sa, ea, _), (sb, eb, _) = self.ta.levels[level], self.tb.levels[level]
        na, nb = self.ta.levels[level + 1][0], self.tb.levels[level + 1][0]
        la, lb = np.searchsorted(na, sa[i]), np.searchsorted(nb, sb[j])
        ka, kb = np.searchsorted(na, ea[i]) - la, np.searchsorted(nb, eb[j]) - lb
        few = ka * kb < 4096
        self._expand(level, i[few], j[few])
        for t in np.flatnonzero(~few).tolist():
            self._dense(level + 1, la[t], la[t] + ka[t], lb[t], lb[t] + kb[t], self.same and i[t] == j[t])

    def _expand(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        (sa, ea, _), (sb, eb, _) = self.ta.levels[level], self.tb.levels[level]
        na, nb = self.ta.levels[level + 1][0], self.tb.levels[level + 1][0]
        la, lb = np.searchsorted(na, sa[i]), np.searchsorted(nb, sb[j])
        ka, kb = np.searchsorted(na, ea[i]) - la, np.searchsorted(nb, eb[j]) - lb
        total = ka * kb
        at = 0
        while at < len(i):
            end = at + max(1, int(np.searchsorted(np.cumsum(total[at:]), self.chunk, side="right")))
            for lo, n in self._slices(at, end, ka):
                t = (n * kb[at:end]) if end - at == 1 else total[at:end]
                which = np.repeat(np.arange(at, end), t)
                k = np.arange(len(which)) - np.repeat(np.cumsum(t) - t, t)
                p, q = la[which] + lo + k // kb[which], lb[which] + k % kb[which]
                if self.same:
                    keep = (i[which] != j[which]) | (p <= q)
                    p, q = p[keep], q[keep]
                self._descend(level + 1, p, q)
            at = end

    @staticmethod
    def _slices(at: int, end: int, ka: np.ndarray):
        """A single pair with very many children is expanded by slices of its first node's children."""
        if end - at > 1:
            return [(0, 0)]
        step = 64
        return [(lo, min(step, int(ka[at]) - lo)) for lo in range(0, int(ka[at]), step)]

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of points: verify in double precision."""
        for at in range(0, len(i), self.chunk):
            p, q = i[at:at + self.chunk], j[at:at + self.chunk]
            good = np.einsum("ij,ij->i", self.ua[p], self.ub[q]) >= self.t
            p, q = p[good], q[good]
            np.add.at(self.wa, p, self.nb[q])
            np.add.at(self.wb, q, self.na[p])
            absorb(self.label, p, q + self.shift)

    def _take(self, sa, ea, sb, eb) -> None:
        """Node pairs of which every point pair is linked."""
        for a, b, c, d in zip(sa.tolist(), ea.tolist(), sb.tolist(), eb.tolist(), strict=True):
            if self.same and a == c and b == d:
                self.wa[a:b] += (self.ca[b] - self.ca[a]) - self.na[a:b]
            else:
                self.wa[a:b] += self.cb[d] - self.cb[c]
                self.wb[c:d] += self.ca[b] - self.ca[a]
            points = np.concatenate([np.arange(a, b), np.arange(c, d) + self.shift])
            absorb(self.label, points, np.full(len(points), a))


def build_block(pdf: pd.DataFrame, cosine: float, kind: str) -> pd.DataFrame:
    x = np.stack(pdf["x"].to_numpy()).astype(kind)
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    data = {"ids": pdf["node"].to_numpy(np.int64), "n": pdf["n"].to_numpy(np.int64), "x": x, "tree": CoverTree(unit(x), eps)}
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "cell": [int(pdf["cell"].iloc[0])],
                         "data": [pickle.dumps(data, protocol=5)]})


def join_blocks(a: dict, b: dict, cosine: float, same: bool) -> tuple[list, list, list]:
    """Columns (a, b, links): link counts have a null b; edges of a spanning forest have 0 links."""
    join = Join(a, b, cosine, same)
    join.run()
    ia, ib = a["ids"][join.ta.order], b["ids"][join.tb.order]
    ids = ia if same else np.concatenate([ia, ib])
    weight = join.wa if same else np.concatenate([join.wa, join.wb])
    at = np.flatnonzero(weight)
    child = np.flatnonzero(join.label != np.arange(len(ids)))
    return (ids[at].tolist() + ids[child].tolist(), [None] * len(at) + ids[join.label[child]].tolist(),
            weight[at].tolist() + [0] * len(child))


def linked_nodes(nodes: DataFrame, cosine: float, dim: int) -> DataFrame:
    """(a, b, links) over distinct vectors (node, n, x): see ``join_blocks``; counts add up over rows."""
    spark = nodes.sparkSession
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    kind = "f4" if dict(nodes.dtypes)["x"] == "array<float>" else "f8"
    total, per = nodes.count(), max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, dim))))
    pivots = unit(np.array([r.x for r in nodes.orderBy(F.xxhash64("node", F.lit("pivot")), "node")
                            .limit(min(PIVOTS, max(1, -(-total // per)))).collect()], dtype=np.float64).reshape(-1, dim))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(2).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
            g = unit(x) @ pivots.T if len(x) else np.zeros((0, len(pivots)))
            cell = g.argmax(1) if len(x) else np.zeros(0, int)
            far = _distance(g[np.arange(len(x)), cell])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(far, pa.float64())],
                                             ["node", "n", "x", "cell", "far"])

    celled = written(nodes.select("node", "n", "x").mapInArrow(
        assign, f"node long, n long, x {dict(nodes.dtypes)['x']}, cell int, far double"), "cells")
    cells = celled.groupBy("cell").agg(F.count("*").alias("rows"), F.max("far").alias("radius")).orderBy("cell").collect()
    plan, first = [], 0                      # at most PIVOTS rows
    for c in cells:
        k = -(-c["rows"] // per)
        plan.append((c["cell"], first, k))
        first += k
    number, radius = np.array([c["cell"] for c in cells], int), np.array([c["radius"] for c in cells])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(ca, cb) of a cell and those after it that are near enough."""
        for b in batches:
            for cell in b.column(0).to_pylist():
                at = int(np.searchsorted(number, cell))
                apart = _distance(pivots[number[at:]] @ pivots[cell])
                near = number[at:][apart <= radius[at:] + radius[at] + eps + SLACK]
                yield pa.RecordBatch.from_arrays([pa.array([cell] * len(near), pa.int32()), pa.array(near, pa.int32())], ["ca", "cb"])

    dealt = celled.join(F.broadcast(spark.createDataFrame(plan, "cell int, first int, k int")), "cell") \
        .withColumn("block", (F.col("first") + F.pmod(F.xxhash64("node", F.lit("block")), F.col("k"))).cast("int"))
    tasks = min(first, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = written(dealt.repartition(tasks, "block").groupBy("block")
                     .applyInPandas(lambda pdf: build_block(pdf, cosine, kind), "block int, cell int, data binary"), "blocks")
    near = spark.createDataFrame([(int(c),) for c in number], "ca int").mapInArrow(meet, "ca int, cb int")
    pairs = written(near
                    .join(blocks.select(F.col("block").alias("ba"), F.col("cell").alias("ca")), "ca")
                    .join(blocks.select(F.col("block").alias("bb"), F.col("cell").alias("cb")), "cb")
                    .where("ba <= bb").select("ba", "bb"), "block-pairs")
    # both blocks of a pair meet under the pair's own key, so pairs spread over tasks however few blocks there are
    wide = max(1, min(2 * pairs.count(), 10_000))
    one = pairs.join(blocks.select(F.col("block").alias("ba"), F.col("data").alias("a")), "ba")
    other = pairs.join(blocks.select(F.col("block").alias("bb"), F.col("data").alias("b")), "bb")
    both = one.repartition(wide, "ba", "bb").join(other.repartition(wide, "ba", "bb"), ["ba", "bb"]).select("ba", "bb", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ba, bb, a, b = (batch.column(c)[k].as_py() for c in range(4))
                left = pickle.loads(a)
                cols = join_blocks(left, left if ba == bb else pickle.loads(b), cosine, ba == bb)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "links"])

    return both.mapInArrow(run, "a long, b long, links long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """(id, n_links, component_id, kept) per row of ``df``.

    n_links counts the other vectors with a cosine of at least ``cosine``;
    component_id is the smallest id reachable over links, itself included. Null,
    empty and zero vectors and those with null or non-finite components link
    with nothing, nor do rows with a null id (their component is null, and they
    are kept). Vectors of different lengths are never compared. Repeated rows
    are vectors each, linked with one another; other columns are not read.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be above 0 and at most 1")
    element = df.schema[vec_col].dataType.elementType.simpleString()
    kind = "float" if element == "float" else "double"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(f"array<{kind}>").alias("x"))
    fine = F.coalesce(F.col("id").isNotNull() & F.exists("x", lambda v: v != 0)
                      & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    # adding zero makes -0.0 and 0.0 equal
    rows = rows.withColumn("fine", fine).withColumn("x", F.when(F.col("fine"), F.transform("x", lambda v: v + F.lit(0.0).cast(kind))))
    nodes = written(rows.where("fine").groupBy("x").agg(F.min("id").alias("node"), F.count("*").alias("n")), "vectors")
    links = None
    for s in nodes.select(F.size("x").alias("dim")).distinct().collect():   # one pass for each vector length
        part = linked_nodes(nodes.where(F.size("x") == s["dim"]), cosine, s["dim"])
        links = part if links is None else links.union(part)
    if links is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = written(links, "links")
    counts = links.where("b is null").groupBy(F.col("a").alias("ca")).agg(F.sum("links").alias("links"))
    roots = connected_components(links.where("b is not null").select("a", "b"))
    per = nodes.join(counts, F.col("node") == F.col("ca"), "left") \
        .join(roots.withColumnRenamed("node", "rn"), F.col("node") == F.col("rn"), "left") \
        .select("x", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    return rows.where("fine").join(per, "x").select("id", "n_links", "component_id") \
        .union(rows.where("not fine").select("id", F.lit(0).cast("long"), "id")) \
        .select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and survival of every vector at cosine 0.9."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""
