"""Whitening of integer vectors by a covariance weighted with multiplicities.

Rows with identical vectors are one distinct vector with a count. The fit list
weighs each distinct vector with its count, or with one. Sums are exact
integers; the covariance adds up, task by task, a matrix product of centred
distinct vectors with weighted ones. Every distinct vector is whitened once, and
the rows get their vector's result back by a join on its digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import written
from .topk_search import valid

COMPONENTS = 32
RANK = 1e-10                     # smaller shares of the largest eigenvalue are rounding, not components
_SAFE = 1 << 62


def quantised(vec_col: str, scale: int, offset: int):
    """floor(scale * component) + offset as long; what does not fit is an error."""
    def one(v):
        y = F.floor(F.lit(float(scale)) * v.cast("double"))
        fits = F.abs(F.lit(float(scale)) * v.cast("double")) < float(_SAFE)
        return F.when(fits, y + F.lit(offset).cast("long")).otherwise(F.raise_error(F.lit("a vector's entry is too large")).cast("long"))
    return F.transform(vec_col, one)


def _digest(x):
    return F.unhex(F.sha2(F.concat_ws(",", x.cast("array<string>")), 256))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Rows of one length."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=kind)
    return flat.reshape(len(column), -1)


def by_length(b: pa.RecordBatch, k: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``rows`` rows whose lists in column ``k`` have one length."""
    size = np.diff(np.asarray(b.column(k).offsets))
    for dim in np.unique(size).tolist():
        at = np.flatnonzero(size == dim)
        part = b if len(at) == len(size) else b.take(pa.array(at))
        for i in range(0, part.num_rows, rows):
            yield part.slice(i, rows)


def rows_of_bytes(dim: int, budget: int = 32 << 20) -> int:
    return max(1, budget // (8 * max(1, dim)))


def exact_sums(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Weighted sums of the columns, as Python integers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if top * int(w.sum()) >= _SAFE:
        x, w = x.astype(object), w.astype(object)
    return [int(v) for v in w @ x]


def scaled_offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit integers where they fit, else Python integers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
    if n * top >= _SAFE or max(map(abs, sums), default=0) >= _SAFE:
        return n * x.astype(object) - np.array(sums, dtype=object)
    return n * x - np.array(sums, dtype=np.int64)


def square_sums(y: np.ndarray) -> list[int | None]:
    """Sum of the squares of every row; None where it does not fit in a long."""
    top = max(int(y.max()), -int(y.min())) if y.size else 0
    if y.dtype != object and top * top * y.shape[1] < 1 << 63:
        return (y * y).sum(1).tolist()
    total = [sum(int(v) ** 2 for v in row) for row in y]
    return [t if t < 1 << 63 else None for t in total]


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Length -> (weight, exact sums of the entries). At most one row a task and length is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for b in batches:
            for part in by_length(b, 0, 1 << 16):
                x, w = _matrix(part.column(0), np.int64), part.column(1).to_numpy()
                new = [int(w.sum()), *exact_sums(x, w)]
                old = held.get(x.shape[1])
                held[x.shape[1]] = new if old is None else [p + q for p, q in zip(old, new, strict=True)]
        dims = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims, pa.int32()), pa.array([[Decimal(v) for v in held[d]] for d in dims], pa.list_(pa.decimal128(38, 0)))],
            ["dim", "s"])

    parts = distinct.select("x", "w").mapInArrow(run, "dim int, s array<decimal(38,0)>")
    total = parts.select("dim", F.posexplode("s").alias("pos", "v")).groupBy("dim", "pos").agg(F.sum("v").alias("v"))
    out: dict[int, dict[int, int]] = {}
    for r in total.collect():
        out.setdefault(r["dim"], {})[r["pos"]] = int(r["v"])
    return {d: (s[0], [s[i] for i in range(1, len(s))]) for d, s in out.items()}


def _products(df: DataFrame, centred, width: dict[int, int]) -> DataFrame:
    """(dim, i, j, v): entries of the weighted sums of outer products of ``centred(dim, x)``.

    ``df`` has a dim, a list and a weight; a task adds up before it hands on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dim in np.unique(b.column(0).to_numpy()).tolist():
                mine = b.filter(pa.compute.equal(b.column(0), dim)) if width.get(dim) else None
                for i in range(0, mine.num_rows if mine else 0, rows_of_bytes(dim)):
                    part = mine.slice(i, rows_of_bytes(dim))
                    y = centred(dim, part.column(1))
                    new = (y * part.column(2).to_numpy().astype(np.float64)[:, None]).T @ y
                    held[dim] = held[dim] + new if dim in held else new
        for dim, m in held.items():
            for i in range(0, len(m), 64):
                rows = m[i:i + 64]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(rows), pa.int32()), pa.array(range(i, i + len(rows)), pa.int32()),
                     pa.array(rows.tolist(), pa.list_(pa.float64()))], ["dim", "i", "row"])

    return df.mapInArrow(run, "dim int, i int, row array<double>") \
        .select("dim", "i", F.posexplode("row").alias("j", "v")).groupBy("dim", "i", "j").agg(F.sum("v").alias("v"))


def eigenbasis(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues above rounding and their unit eigenvectors (columns), each with its largest entry positive."""
    e, u = np.linalg.eigh((v + v.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    keep = (e > RANK * max(float(e[0]), 0.0)) & (e > 0)
    e, u = e[keep][:components], u[:, keep][:, :components]
    return e, u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, offset: int = 1_000_000,
           components: int = COMPONENTS, weights: str = "counts") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) of every row with a usable vector.

    Entries c become the integers x = floor(scale * c) + offset. With n the
    weight of the fit list, S its sums and V its covariance (divisor n):
    ``deviation`` is the exact sum of (n x - S)^2, null beyond a long;
    ``whitened`` holds x - S/n projected on the components of V, each divided by
    the root of its eigenvalue, ``explained`` their shares of V's trace (arrays,
    at most ``components``, by falling eigenvalue); ``identity_error`` is the
    largest entry of whitened's covariance minus the identity.
    ``weights``: 'counts' (every row) or 'one' (every distinct vector).

    Rows whose vector is null or holds null or non-finite entries are left out.
    Vectors of different lengths are fitted each length by itself; the sums,
    components and covariance of a length, but no rows, come to the driver or one
    task. Directions without variance are no components, so equal vectors, and
    empty ones, have empty arrays and a null error. Repeated rows and null ids
    stay, one output row each; other columns are not read.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be 'counts' or 'one'")
    rows = df.where(valid(vec_col)).select(F.col(id_col).alias("id"), quantised(vec_col, scale, offset).alias("x")) \
        .withColumn("key", _digest(F.col("x")))
    distinct = rows.groupBy("key", "x").agg(F.count("*").alias("c"))
    distinct = written(distinct.select("key", "x", (F.col("c") if weights == "counts" else F.lit(1).cast("long")).alias("w")), "distinct-vectors")
    fit = _sums(distinct)

    def centred(dim, column):
        n, sums = fit[dim]
        return scaled_offsets(_matrix(column, np.int64), n, sums).astype(np.float64) / n

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        v = np.zeros((dim, dim))
        v[pdf["i"], pdf["j"]] = pdf["v"] / fit[dim][0]
        e, u = eigenbasis(v, components)
        return pd.DataFrame({"dim": [dim], "e": [e.tolist()], "u": [u.ravel().tolist()], "trace": [float(np.trace(v))]})

    products = _products(distinct.select(F.size("x").alias("dim"), "x", "w"), centred, {d: d for d in fit})
    models = {r["dim"]: (np.array(r["e"]), np.array(r["u"]).reshape(r["dim"], -1), r["trace"])
              for r in products.groupBy("dim").applyInPandas(solve, "dim int, e array<double>, u array<double>, trace double").collect()}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in by_length(b, 1, 1 << 16):
                dim = len(some.column(1)[0])
                for i in range(0, some.num_rows, rows_of_bytes(dim)):
                    part = some.slice(i, rows_of_bytes(dim))
                    y = scaled_offsets(_matrix(part.column(1), np.int64), *fit[dim])
                    if dim in models:
                        e, u, _ = models[dim]
                        z = (y.astype(np.float64) / fit[dim][0]) @ u / np.sqrt(e)
                    else:
                        z = np.zeros((len(y), 0))
                    ends = pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array([dim] * len(z), pa.int32()), part.column(2), pa.array(square_sums(y), pa.int64()),
                         pa.ListArray.from_arrays(ends, pa.array(z.ravel()))], ["key", "dim", "w", "deviation", "z"])

    white = written(distinct.mapInArrow(project, "key binary, dim int, w long, deviation long, z array<double>"), "whitened")
    errors = _identity_errors(white, {d: n for d, (n, _) in fit.items()}, {d: len(m[0]) for d, m in models.items()})
    facts = [(d, n, (models[d][0] / models[d][2]).tolist() if d in models else [], errors.get(d)) for d, (n, _) in fit.items()]
    facts = df.sparkSession.createDataFrame(facts, "f_dim int, n long, explained array<double>, identity_error double")
    return rows.select("id", "key").join(white.select("key", "dim", "deviation", "z"), "key") \
        .join(facts, F.col("dim") == F.col("f_dim")) \
        .select(F.col("id").alias(id_col), "n", "deviation", F.col("z").alias("whitened"), "explained", "identity_error")


def _identity_errors(white: DataFrame, n: dict[int, int], width: dict[int, int]) -> dict[int, float]:
    """Length -> largest entry of the covariance of the whitened vectors minus the identity."""
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for dim in np.unique(b.column(0).to_numpy()).tolist():
                if width.get(dim):
                    part = b.filter(pa.compute.equal(b.column(0), dim))
                    held[dim] = held.get(dim, 0.0) + part.column(2).to_numpy().astype(np.float64) @ _matrix(part.column(1), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                          pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], ["dim", "s"])

    columns = white.select("dim", "z", "w")
    mean: dict[int, dict[int, float]] = {}
    for r in columns.mapInArrow(total, "dim int, s array<double>").select("dim", F.posexplode("s").alias("i", "v")) \
            .groupBy("dim", "i").agg(F.sum("v").alias("v")).collect():
        mean.setdefault(r["dim"], {})[r["i"]] = r["v"] / n[r["dim"]]
    means = {d: np.array([m[i] for i in range(len(m))]) for d, m in mean.items()}
    off = _products(columns, lambda dim, column: _matrix(column, np.float64) - means[dim], width)
    rows = off.join(df_of(white.sparkSession, n), "dim").select(
        "dim", F.abs(F.col("v") / F.col("n") - (F.col("i") == F.col("j")).cast("double")).alias("e"))
    return {r["dim"]: r["e"] for r in rows.groupBy("dim").agg(F.max("e").alias("e")).collect()}


def df_of(spark: SparkSession, n: dict[int, int]) -> DataFrame:
    return spark.createDataFrame(list(n.items()), "dim int, n long")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened along the 32 strongest components of all vectors' covariance."""
    rows = whiten(read_table(spark, sf_dir, "embeddings"))
    one = rows.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("at", "whitened"))
    return one.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                      F.get("explained", F.col("at")).alias("explained"), "identity_error")
