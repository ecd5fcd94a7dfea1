"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learnt from labelled rows: words and word beginnings found far
more often in toxic texts. Lexicon counts and dense features are computed on
the executors; the driver gets the terms of the bounded sample that are clearly
toxic and the sample's dense features, and sends back a small model.
"""

from __future__ import annotations

import re
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

MAX_TRAIN_ROWS = 12_000          # bound on the training sample
SURE, LEAST_ODDS = 1.96, 1.0     # a term's log odds less so many standard errors must exceed the latter
STEMS = (4, 5, 6, 7)             # lengths of word beginnings that count as terms
NEAR = 6                         # words between a second person and a lexicon term
MEMO = 300_000

_WORD = re.compile(r"[^\W_]+(?:[*@$#%0-9!|+]+[^\W_]+)*")
_MASKED = re.compile(r"[^\W\d_]+[*@$#%0-9!|+]+[^\W\d_]+")
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen deiner euch euer ihr sie "
                          "tu te toi ton ta tes vous votre vos ti usted ustedes vosotros tus su".split())
FEATURES = ("best term", "term density", "distinct terms", "summed weight", "weight density", "near second person",
            "second person", "capitals", "capital words", "exclamations", "other punctuation", "digits",
            "masked words", "masked terms", "repeated letters", "words")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def plain(word: str) -> str:
    """A word with common letter substitutions undone and masking signs removed."""
    return re.sub(r"[^\w]", "", word.translate(_PLAIN))


def terms_of(word: str) -> list[str]:
    """A word and its beginnings (marked by a trailing hyphen)."""
    return [word, *(f"{word[:n]}-" for n in STEMS if len(word) >= n)]


def count_terms(sample: DataFrame) -> DataFrame:
    """(term, p0, n0, p1, n1): texts with the term by fold and label, combined in Python before the shuffle."""
    schema = T.StructType([T.StructField("term", T.StringType())]
                          + [T.StructField(c, T.LongType()) for c in ("p0", "n0", "p1", "n1")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            counts = [Counter() for _ in range(4)]
            for text, y, fold in zip(*(c.to_pylist() for c in b.columns), strict=True):
                found = {t for w in set(words_of(text)) for t in terms_of(w)}
                counts[2 * fold + (y < 0.5)].update(found)
            keys = list(set().union(*counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)],
                schema.names)

    return sample.select("text", "y", "fold").mapInArrow(run, schema).groupBy("term") \
        .agg(*(F.sum(c).alias(c) for c in schema.names[1:]))


def lexicon(rows: list[tuple[str, float, float]], n_pos: float, n_neg: float) -> dict[str, float]:
    """Terms with the lower confidence bound of their log odds: clearly likelier in toxic texts than elsewhere."""
    out = {}
    for term, p, n in rows:
        w = np.log((p + 0.5) / (n_pos + 1)) - np.log((n + 0.5) / (n_neg + 1)) - SURE * np.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))
        if p and w > LEAST_ODDS:
            out[term] = float(w)
    return out


def clear_terms(counts: DataFrame, n: list[list[int]]) -> DataFrame:
    """The rows of ``count_terms`` that are in the lexicon of either fold or of both together.

    The rule is ``lexicon``'s, a threshold and no number of terms; each fold is
    judged by its own counts.
    """
    def weight(p, q, n_pos: int, n_neg: int):
        p, q = p.cast("double") + 0.5, q.cast("double") + 0.5
        return F.log(p / (n_pos + 1)) - F.log(q / (n_neg + 1)) - SURE * F.sqrt(1 / p + 1 / q)

    p0, n0, p1, n1 = (F.col(c) for c in ("p0", "n0", "p1", "n1"))
    clear = [(p0, n0, *n[0]), (p1, n1, *n[1]), (p0 + p1, n0 + n1, n[0][0] + n[1][0], n[0][1] + n[1][1])]
    return counts.where(F.greatest(*(weight(*x) for x in clear)) > LEAST_ODDS - 1e-9)


class _Weights(dict):
    """word -> largest lexicon weight among its terms, remembered."""

    def __init__(self, lex: dict[str, float]):
        super().__init__()
        self.lex = lex

    def __missing__(self, word: str) -> float:
        w = max(self.lex.get(t, 0.0) for t in terms_of(word))
        if len(self) >= MEMO:
            self.clear()
        self[word] = w
        return w


_CAPS = np.arange(65, 91)
_OTHER = np.array([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "!?"])


def features(text: str, weights: _Weights) -> list[float]:
    """The dense features of a whole text (see FEATURES); all zero for an empty one."""
    words = words_of(text)
    n = max(1, len(words))
    w = list(map(weights.__getitem__, words))
    hits = [i for i, x in enumerate(w) if x]
    total = sum(w)
    second = [i for i, x in enumerate(words) if x in SECOND_PERSON]
    at = np.array(second)
    near = 0
    if hits and second:
        k = np.searchsorted(at, hits)
        left = np.abs(np.array(hits) - at[np.maximum(k - 1, 0)])
        right = np.abs(at[np.minimum(k, len(at) - 1)] - np.array(hits))
        near = int((np.minimum(left, right) <= NEAR).sum())
    masked = _MASKED.findall(text) if re.search(r"[*@$#%0-9!|+]", text) else []
    unmasked = [weights[plain(m.lower())] for m in masked]
    count = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    chars = max(1, len(text))
    capital_words = len(re.findall(r"\b[A-Z]{3,}\b", text))
    return [max(w, default=0.0), len(hits) / n, float(len({words[i] for i in hits})), total, total / n, near / n,
            len(second) / n, count[_CAPS].sum() / chars, capital_words / n, (count[33] + count[63]) / chars,
            count[_OTHER].sum() / chars, count[48:58].sum() / chars, len(masked) / n,
            max(unmasked, default=0.0), len(re.findall(r"([^\W\d_])\1\1", text)) / n, float(np.log1p(len(words)))]


@dataclass
class Tree:
    """A tree of fixed depth in heap order: feature, threshold (go right if above) and leaf values."""
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        for _ in range(int(np.log2(len(self.leaf)))):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return self.leaf[node - len(self.feature)]


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Tree]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += self.rate * t(x)
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.2,
          bins: int = 32, ridge: float = 2.0) -> Boosted:
    """Second-order boosting of the logistic loss over quantile histograms."""
    p0 = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(p0 / (1 - p0))), rate, [])
    if len(y) == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
    cuts = [np.unique(np.append(c, [x[:, f].min()])) for f, c in enumerate(cuts)]
    coded = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    raw = np.full(len(y), model.start)
    inner = 2 ** depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            at = node - first
            sums = np.bincount(at, g, width), np.bincount(at, h, width)
            whole = sums[0] ** 2 / (sums[1] + ridge)
            for f, c in enumerate(cuts):
                k = len(c) + 1
                gl = np.bincount(at * k + coded[:, f], g, width * k).reshape(width, k).cumsum(1)[:, :-1]
                hl = np.bincount(at * k + coded[:, f], h, width * k).reshape(width, k).cumsum(1)[:, :-1]
                gr, hr = sums[0][:, None] - gl, sums[1][:, None] - hl
                gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - whole[:, None]
                j = gain.argmax(1)
                top = gain[np.arange(width), j]
                for i in np.flatnonzero(top > best + 1e-9):
                    best[i], feature[first + i], cut[first + i] = top[i], f, c[j[i]]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        at = node - inner
        leaf = np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        model.trees.append(Tree(feature, cut, leaf))
        raw += rate * leaf[at]
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: increasing (score, probability) knots; between them the curve is linear."""
    if not len(y):
        return np.array([0.0]), np.array([0.0])
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []               # sum of y, weight, sum of scores
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([v, 1.0, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    at = np.array([b[2] / b[1] for b in blocks])
    return at, np.array([(b[0] + 0.5 * 0.1) / (b[1] + 0.1) for b in blocks])


@dataclass
class ToxicityModel:
    lex: dict[str, float]
    trees: Boosted
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: list[str | None], weights: _Weights) -> np.ndarray:
        x = np.array([features(t or "", weights) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return np.clip(np.interp(self.trees(x), *self.knots), 0.0, 1.0)


def _dense(sample: DataFrame, lexicons: list[dict[str, float]]) -> DataFrame:
    """The sample's dense features by the lexicon of the whole sample and by that of the other fold."""
    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("fold", T.IntegerType()),
                           T.StructField("x", T.ArrayType(T.DoubleType())),
                           T.StructField("other", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = [_Weights(lex) for lex in lexicons]
        for b in small_batches(batches):
            rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([y for _, y, _ in rows], pa.float64()), pa.array([f for *_, f in rows], pa.int32()),
                 pa.array([features(t, w[2]) for t, *_ in rows], pa.list_(pa.float64())),
                 pa.array([features(t, w[1 - f]) for t, _, f in rows], pa.list_(pa.float64()))], schema.names)

    return sample.select("text", "y", "fold").mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS) -> ToxicityModel:
    """Fit on about ``max_rows`` labelled rows that are not held out.

    Half the sample learns lexicon and trees that score the other half; those
    out-of-fold scores calibrate. Without labels every text gets the score 0.
    """
    sample = written(training_sample(docs, labels, id_col, text_col, label_col, max_rows), "toxicity-sample")
    totals = {(r.fold, r.pos): r["count"] for r in
              sample.groupBy("fold", (F.col("y") >= 0.5).alias("pos")).count().collect()}
    if not totals:
        return ToxicityModel({}, Boosted(0.0, 0.0, []), (np.array([0.0]), np.array([0.0])))
    n = [[totals.get((f, True), 0), totals.get((f, False), 0)] for f in (0, 1)]
    rows = clear_terms(count_terms(sample), n).collect()
    lexicons = [lexicon([(r.term, r.p0, r.n0) for r in rows], *n[0]),
                lexicon([(r.term, r.p1, r.n1) for r in rows], *n[1]),
                lexicon([(r.term, r.p0 + r.p1, r.n0 + r.n1) for r in rows],
                        n[0][0] + n[1][0], n[0][1] + n[1][1])]
    dense = _dense(sample, lexicons).collect()
    y = np.array([r.y >= 0.5 for r in dense], dtype=float)
    fold = np.array([r.fold for r in dense])
    x, other = np.array([r.x for r in dense]), np.array([r.other for r in dense])
    raw = np.zeros(len(y))
    for f in (0, 1):
        raw[fold == f] = boost(other[fold != f], y[fold != f])(other[fold == f])
    # a tree for texts scored with the whole lexicon is fitted on features of the other fold's lexicon
    # too, so it does not trust a term only because its own text put it into the lexicon
    trees = boost(np.concatenate([x, other]), np.concatenate([y, y]))
    return ToxicityModel(lexicons[2], trees, isotonic(raw, y))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) per row: whole texts, null and empty ones scored as empty;
    repeated rows and null ids stay; other columns of ``docs`` are not read."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _Weights(model.lex)
        for b in small_batches(batches):
            s = model.score(b.column(2).to_pylist(), weights)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64())], schema.names)

    return docs.select(F.col(id_col), held_out(id_col).alias("held_out"), F.col(text_col)) \
        .mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document, learnt from the labelled rows that are not held out."""
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
