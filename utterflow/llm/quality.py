"""Quality classifier: cumulative-link (proportional odds) regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds give P(grade >= k). Expected grade and tail probability select texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import read_table
from .common import documents, small_batches, written
from .labelled import held_out, training_sample

MAX_TRAIN_ROWS = 8_000           # bound on the training sample
BUCKETS = 1 << 16
MAX_GRADES = 32
FORM_WEIGHT = 0.5                # size of the two features of a text's form
MEMO = 200_000

_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")


def _shape(token: str) -> str:
    """Form of a token: kind, case and length class."""
    if token.isalpha():
        kind = "u" if token.isupper() else "l" if token.islower() else "t" if token.istitle() else "m"
    else:
        kind = "d" if token.isdigit() else "x" if token.isalnum() else "p"
    return f"{kind}{min(len(token), 20) // 4}"


class _Buckets(dict):
    """token -> buckets of its lower-cased form and of its shape, remembered."""

    def __missing__(self, token: str) -> tuple[int, int]:
        out = (zlib.crc32(token.lower().encode("utf-8", "surrogatepass")) % BUCKETS,
               zlib.crc32(b"shape:" + _shape(token).encode()) % BUCKETS)
        if len(self) >= MEMO:
            self.clear()
        self[token] = out
        return out


def hashed(text: str, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Bucket indices and values of a whole text: square roots of counts, scaled to unit length,
    and one feature each for the tenth that the share of distinct tokens and of the commonest is in."""
    counts = Counter(_TOKEN.findall(text))
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    total = sum(counts.values())
    forms = [zlib.crc32(f"{name}:{int(10 * share)}:{min(total, 1000) // 20 > 0}".encode()) % BUCKETS
             for name, share in (("distinct", len(counts) / total), ("commonest", max(counts.values()) / total))]
    idx = np.array([buckets[t] for t in counts], dtype=np.int64)
    n = np.fromiter(counts.values(), dtype=float, count=len(counts))
    at, inverse = np.unique(idx.ravel(), return_inverse=True)
    v = np.sqrt(np.bincount(inverse, np.repeat(n, 2)))
    return (np.concatenate([at, forms]).astype(np.int32),
            np.concatenate([v / np.linalg.norm(v), [FORM_WEIGHT] * 2]).astype(np.float32))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class OrdinalModel:
    grades: np.ndarray          # ascending
    weights: np.ndarray
    cuts: np.ndarray            # ascending, one less than grades

    def tails(self, margin: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k >= 1, one row per margin."""
        return _sigmoid(margin[:, None] - self.cuts[None, :])

    def margin(self, at: np.ndarray, v: np.ndarray) -> float:
        return float(self.weights[at] @ v)

    def judge(self, margin: np.ndarray, min_grade: float) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the probability of at least ``min_grade``."""
        if not len(self.grades):
            return np.full(len(margin), np.nan), np.ones(len(margin))
        t = self.tails(margin)
        expected = self.grades[0] + t @ np.diff(self.grades)
        k = int(np.searchsorted(self.grades, min_grade))
        tail = np.ones(len(margin)) if k == 0 else np.zeros(len(margin)) if k == len(self.grades) else t[:, k - 1]
        return expected, tail


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, steps: int = 200,
                rate: float = 0.15, ridge: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood by Adam on all rows; thresholds stay ordered (first cut plus positive gaps)."""
    grades = np.unique(y)
    if len(grades) > MAX_GRADES:
        raise ValueError(f"{len(grades)} grades; ratings must have at most {MAX_GRADES}")
    k = len(grades) - 1
    if k < 1:
        return OrdinalModel(grades, np.zeros(BUCKETS), np.zeros(0))
    g = np.searchsorted(grades, y)
    at = np.concatenate([r[0] for r in rows]).astype(np.int64)
    v = np.concatenate([r[1] for r in rows]).astype(float)
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    share = np.array([(g >= j).mean() for j in range(1, k + 1)]).clip(1e-4, 1 - 1e-4)
    cuts0 = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(k))
    p = np.concatenate([np.zeros(BUCKETS), cuts0[:1], np.log(np.maximum(np.diff(cuts0), 1e-3))])
    m, s = np.zeros_like(p), np.zeros_like(p)
    upper = np.arange(1, k + 1)[None, :] <= g[:, None]       # threshold below the grade
    for step in range(1, steps + 1):
        w, gaps = p[:BUCKETS], np.exp(p[BUCKETS + 1:])
        cuts = np.concatenate([p[BUCKETS:BUCKETS + 1], p[BUCKETS] + np.cumsum(gaps)])
        z = np.bincount(row, w[at] * v, minlength=len(rows))
        tails = _sigmoid(z[:, None] - cuts[None, :])
        full = np.concatenate([np.ones((len(z), 1)), tails, np.zeros((len(z), 1))], axis=1)
        i = np.arange(len(z))
        prob = np.maximum(full[i, g] - full[i, g + 1], 1e-9)
        slope = np.concatenate([np.zeros((len(z), 1)), tails * (1 - tails), np.zeros((len(z), 1))], axis=1)
        up, down = slope[i, g] / prob, slope[i, g + 1] / prob
        dz = -(up - down) / len(z)
        dcut = np.zeros(k + 2)
        np.add.at(dcut, g, up / len(z))
        np.add.at(dcut, g + 1, -down / len(z))
        dcut = dcut[1:-1]
        grad = np.empty_like(p)
        grad[:BUCKETS] = np.bincount(at, v * dz[row], minlength=BUCKETS) + ridge * w
        grad[BUCKETS] = dcut.sum()
        grad[BUCKETS + 1:] = gaps * dcut[::-1].cumsum()[::-1][1:]
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad ** 2
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return OrdinalModel(grades, p[:BUCKETS], np.concatenate([p[BUCKETS:BUCKETS + 1], p[BUCKETS] + np.cumsum(np.exp(p[BUCKETS + 1:]))]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> OrdinalModel:
    """Fit on about ``max_rows`` rated rows that are not held out; only their hashed features
    (at most BUCKETS numbers a row) come to the driver."""
    sample = training_sample(docs, labels, id_col, text_col, label_col, max_rows)
    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("at", T.BinaryType()),
                           T.StructField("v", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for b in small_batches(batches):
            rows = [hashed(t, buckets) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([a.tobytes() for a, _ in rows], pa.binary()),
                 pa.array([v.tobytes() for _, v in rows], pa.binary())], schema.names)

    got = written(sample.select("text", "y").mapInArrow(run, schema), "quality-sample").collect()
    rows = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["v"], np.float32)) for r in got]
    return fit_ordinal(rows, np.array([r["y"] for r in got]))


def judged(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
           min_grade: float = 1.0, min_tail: float = 0.5, carry: list[str] | None = None) -> DataFrame:
    """(id, carried columns, held_out, expected_grade, tail_probability, keep) per row of ``docs``.

    ``keep`` is true where P(grade >= ``min_grade``) is at least ``min_tail``.
    Null and empty texts are judged as texts without tokens. Without any rating
    the expected grade is null and all rows stay. Repeated rows and null ids
    stay, one output row each. Carried columns go through the task unread.
    """
    carry = [c for c in carry or [] if c != id_col]
    inner = [f"c{i}" for i in range(len(carry))]
    text_at = 1 + carry.index(text_col) if text_col in carry else -1
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType)]
                          + [T.StructField(n, docs.schema[c].dataType) for n, c in zip(inner, carry)]
                          + [T.StructField("held_out", T.BooleanType()), T.StructField("expected_grade", T.DoubleType()),
                             T.StructField("tail_probability", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for b in small_batches(batches):
            margin = np.array([model.margin(*hashed(t or "", buckets)) for t in b.column(text_at % b.num_columns).to_pylist()])
            grade, tail = model.judge(margin, min_grade)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(schema) - 2], pa.array(grade, pa.float64(), from_pandas=True), pa.array(tail, pa.float64())],
                schema.names)

    text = [] if text_at > 0 else [F.col(text_col).alias("text")]
    return docs.select(F.col(id_col).alias("id"), *(F.col(c).alias(n) for n, c in zip(inner, carry)),
                       held_out(id_col).alias("held_out"), *text) \
        .mapInArrow(run, schema) \
        .select(F.col("id").alias(id_col), *(F.col(n).alias(c) for n, c in zip(inner, carry)),
                "held_out", "expected_grade", "tail_probability",
                (F.col("tail_probability") >= min_tail).alias("keep"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every whole document."""
    docs = documents(spark, sf_dir)
    return judged(docs, fit(docs, read_table(spark, sf_dir, "labels")))
