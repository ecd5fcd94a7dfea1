import math
import operator

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterflow.llm import topk_search as S
from utterflow.llm.queries import LLM_QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def slow(rows, asks, k, kind=np.float32):
    x = sorted({(i, tuple(math.floor(1024 * float(kind(c))) for c in v)) for i, v in rows
                if i is not None and v and all(c is not None and np.isfinite(c) for c in v)})
    out = []
    for at, (q, u) in enumerate(x):
        if asks(q):
            near = sorted((-sum(map(operator.mul, u, v)), i) for k, (i, v) in enumerate(x) if k != at and len(v) == len(u))[:k]
            out += [(q, r + 1, i, -s if abs(s) < 1 << 63 else None) for r, (s, i) in enumerate(near)]
    return sorted(out, key=str)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = S.Block(np.arange(200), np.arange(200), np.floor(rng.normal(size=(200, 37)) * 1024))
    i, j = np.divmod(np.arange(200 * 200), 200)
    exact = (x.x @ x.x.T).ravel()
    last = np.full(len(i), np.inf)
    for level in range(len(S.LEVELS)):
        bound = S.upper_bounds(x, i, x, j, level)
        assert (bound >= exact - 1e-3).all() and bound.mean() <= last.mean()
        last = bound


@pytest.mark.parametrize("dim", [1, 3, 64])
def test_equals_brute_force_with_ties_over_blocks(spark, monkeypatch, dim):
    rng = np.random.default_rng(dim)
    v = rng.normal(size=(60, dim)).round(1)
    rows = [(int(i), [float(c) for c in v[rng.integers(60)]]) for i in range(400)]
    monkeypatch.setattr(S, "QUERY_BLOCK", 16)
    monkeypatch.setattr(S, "VECTOR_BLOCK", 50)
    got = S.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 5 == 0).collect()
    assert sorted(map(tuple, got), key=str) == slow(rows, lambda q: q % 5 == 0, 10)


def test_odd_vectors_and_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 0.0]), (4, [None, 1.0]), (5, []), (6, [0.0, 0.0]),
            (100, [1.0, -1.0]), (200, [3.0]), (300, [4.0]), (None, [9.0, 9.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", rank int, x string")
    got = sorted(map(tuple, S.top_k(df, F.col("vec_id") % 100 == 0).collect()), key=str)
    assert got == slow(rows, lambda q: q % 100 == 0, 10)
    assert S.top_k(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_query_rows(spark):
    SF_SMALL = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, LLM_QUERIES["op7_exact_topk"](spark, SF_SMALL).collect()), key=str) == slow(rows, lambda q: q % 100 == 0, 10)


def test_one_id_with_several_vectors(spark):
    """Rows with one id and different vectors are queries and candidates each; only a row itself is left out."""
    rows = [(0, [1.0, 2.0]), (0, [2.0, 1.0]), (0, [2.0, 1.0]), (14, [1.0, 1.0]), (14, [3.0, 0.0]), (5, [0.0, 1.0])]
    got = S.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, k=3).collect()
    assert sorted(map(tuple, got), key=str) == slow(rows, lambda q: q % 100 == 0, 3)
    assert len(got) == 6 and sum(r.vec_id == 0 for r in got) >= 1


def test_scores_of_any_size_are_exact(spark):
    rng = np.random.default_rng(3)
    big = [(i, [float(c) for c in rng.normal(size=3) * 10.0 ** rng.integers(0, 13)]) for i in range(120)]
    big += [(200, [9e5, 1.0, 1 / 1024]), (300, [9e5, 1.0, 2 / 1024]), (301, [9e5, 1.0, 2 / 1024]), (302, [1e14, 0.0, 0.0]), (400, [1e14, 1.0, 0.0])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = S.top_k(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got), key=str) == slow(big, lambda q: q % 20 == 0, 10, np.float64)
    assert any(r.score is None for r in got) and any(r.score is not None and r.score > 2 ** 53 for r in got)
    with pytest.raises(ValueError, match="1e37"):
        S.top_k(spark.createDataFrame([(0, [1e17])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0)


def test_boxes_bound_their_vectors():
    rng = np.random.default_rng(1)
    q, x = (S.Block(np.arange(n), np.arange(n), np.floor(rng.normal(size=(n, 21)) * 300 + shift)) for n, shift in ((40, 0), (60, 100)))
    bound = S.box_bounds(q, np.stack([x.box(), q.box()]))
    assert (bound[:, 0] >= (q.x @ x.x.T).max(1) - 1e-3).all() and (bound[:, 1] >= (q.x @ q.x.T).max(1) - 1e-3).all()


def test_pairs_of_blocks_are_pruned_on_clusters(spark, monkeypatch):
    """Far clusters are never paired, results stay exact, and the share of pairs falls with the table."""
    share = []
    real = S.block_pairs

    def counted(asks, boxes, dim):
        pairs = real(asks, boxes, dim)
        share.append(pairs.count() / (asks.count() * boxes.count()))
        return pairs

    monkeypatch.setattr(S, "block_pairs", counted)
    monkeypatch.setattr(S, "QUERY_BLOCK", 10)
    monkeypatch.setattr(S, "VECTOR_BLOCK", 100)
    rng = np.random.default_rng(2)
    for n, clusters in ((600, 4), (4000, 30)):
        centre = rng.normal(size=(clusters, 8)) * 4
        v = centre[np.arange(n) % clusters] + 0.05 * rng.normal(size=(n, 8))
        rows = [(int(i), np.float32(x).tolist()) for i, x in enumerate(v)]
        got = S.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect()
        assert sorted(map(tuple, got), key=str) == slow(rows, lambda q: q % 100 == 0, 10)
    assert share[0] < 1 and share[1] < 0.6


def test_blocks_are_bounded_in_bytes():
    assert S.block_rows(8192, 4 << 20, 64) == 8192 and S.block_rows(8192, 4 << 20, 4096) == 128 and S.block_rows(8192, 4 << 20, 10 ** 7) == 1
