import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from utterflow.llm import whitening as W
from utterflow.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def plain(x, weigh_one=False, components=32):
    """Deviations (Python integers), eigenvalues and shares of the trace, whitened up to signs, by the definition."""
    fit = np.unique(x, axis=0) if weigh_one else x
    n, sums = len(fit), [sum(int(v) for v in col) for col in fit.T]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    mean = np.array([s / n for s in sums])
    v = (fit - mean).T @ (fit - mean) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return n, deviation, e / np.trace(v), (x - mean) @ u / np.sqrt(e)


def vectors(rows, scale=64, offset=1_000_000):
    return np.array([[math.floor(scale * float(np.float32(c))) + offset for c in v] for _, v in rows], dtype=np.int64)


def compare(got, rows, weights, components):
    x = vectors(rows)
    n, deviation, explained, white = plain(x, weights == "one", components)
    got = sorted(got, key=lambda r: r["vec_id"])
    assert [r["vec_id"] for r in got] == sorted(i for i, _ in rows)
    by_id = {i: k for k, (i, _) in enumerate(rows)}
    z = np.array([r["whitened"] for r in got])
    want = white[[by_id[r["vec_id"]] for r in got]]
    assert z.shape == want.shape
    sign = np.sign((z * want).sum(0))
    assert np.abs(z * sign - want).max() < 1e-6
    for r in got:
        assert r["n"] == n and r["deviation"] == deviation[by_id[r["vec_id"]]]
        assert np.allclose(r["explained"], explained, rtol=1e-6) and 0 <= r["identity_error"] < 1e-8
    mine = np.unique(np.concatenate([z, x], axis=1), axis=0)[:, :z.shape[1]] if weights == "one" else z
    c = mine - mine.mean(0)
    assert np.abs(c.T @ c / len(c) - np.eye(z.shape[1])).max() < 1e-6


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_equals_the_definition(spark, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(80, 6)) * [5, 3, 2, 1, 0.7, 0.5]
    pick = np.concatenate([np.zeros(120, int), rng.integers(80, size=200), np.arange(80)])     # a third of the rows are one vector
    rows = [(int(i), [float(c) for c in base[p]]) for i, p in enumerate(pick)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    compare(W.whiten(df, weights=weights, components=4).collect(), rows, weights, 4)


def test_query_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = LLM_QUERIES["op11_whitening"](spark, SF).collect()
    per = {}
    for r in got:
        per.setdefault(r.vec_id, {})[r.component] = r
    whole = [{"vec_id": i, "n": c[1].n, "deviation": c[1].deviation, "identity_error": c[1].identity_error,
              "whitened": [c[k].whitened for k in range(1, 33)], "explained": [c[k].explained for k in range(1, 33)]}
             for i, c in per.items()]
    assert len(got) == 32 * len(rows)
    compare(whole, rows, "counts", 32)


def test_odd_vectors_and_columns(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(90, None), (91, [nan, 1.0]), (92, [inf, 0.0]), (93, [None, 1.0])]
    rows = [(1, [0.5, 1.0]), (2, [0.25, -1.0]), (2, [0.25, -1.0]), (3, [0.0, 3.0]), (None, [0.5, 1.0])]
    other = [(4, [1.0]), (5, [2.0]), (6, [3.0, 3.0, 3.0]), (7, [])]
    schema = SCHEMA + ", n int, key string, x string, dim int, w int, id int"
    df = spark.createDataFrame([(*r, 1, "k", "x", 1, 1, 1) for r in bad + rows + other], schema)
    got = W.whiten(df).collect()
    assert sorted(r.vec_id or 0 for r in got) == [0, 1, 2, 2, 3, 4, 5, 6, 7]
    two = [r for r in got if r.vec_id in (None, 1, 2, 3)]
    x = vectors(rows)
    n, deviation, explained, white = plain(x)
    for r in two:
        k = [i for i, _ in rows].index(r.vec_id)
        assert r.n == 5 and r.deviation == deviation[k] and np.allclose(r.explained, explained)
        assert np.allclose(np.abs(r.whitened), np.abs(white[k]))
    one = {r.vec_id: r for r in got if r.vec_id in (4, 5, 6, 7)}
    assert [round(one[i].whitened[0], 9) for i in (4, 5)] == [-1, 1] and one[4].deviation == 64 ** 2 and one[4].explained == [1.0]
    assert one[6].whitened == [] and one[6].n == 1 and one[6].deviation == 0 and one[6].identity_error is None
    assert one[7].whitened == [] and one[7].deviation == 0
    assert W.whiten(df.limit(0)).collect() == [] and W.whiten(df.where("vec_id >= 90")).collect() == []


def test_exact_beyond_64_bits():
    x = np.array([[1 << 40, -5], [3, 7], [-(1 << 41), 11]], dtype=np.int64)
    w = np.array([1 << 30, 2, 5])
    sums = W.exact_sums(x, w)
    assert sums == [sum(int(a) * int(b) for a, b in zip(col, w, strict=True)) for col in x.T]
    n = int(w.sum())
    y = W.scaled_offsets(x, n, sums)
    assert [[int(v) for v in r] for r in y] == [[n * int(v) - s for v, s in zip(row, sums, strict=True)] for row in x]
    assert W.square_sums(y)[0] is None and W.square_sums(np.array([[1 << 31, 3]])) == [(1 << 62) + 9]
    assert W.square_sums(np.array([[1 << 32, 3], [1, 1]])) == [None, 2]


def test_large_and_flat_vectors(spark):
    for factor, width in ((1e3, 2), (1e9, 1)):                   # a constant dimension is no component, nor is what rounding hides
        rows = [(i, [float(i % 3) * factor, 1.0, float(i)]) for i in range(9)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = W.whiten(df).collect()
        x = vectors(rows)
        assert all(len(r.whitened) == width and r.identity_error < 1e-4 for r in got)
        want = [d if d < 1 << 63 else None for d in plain(x)[1]]
        assert [r.deviation for r in sorted(got)] == want
    with pytest.raises(Exception, match="too large"):
        W.whiten(spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")).collect()
    with pytest.raises(ValueError):
        W.whiten(df, weights="both")
    assert df.select(W.quantised("embedding", 64, 5).alias("x")).where(F.col("x")[1] == 69).count() == 9
