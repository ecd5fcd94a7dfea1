"""Periodic runs of words, by string synchronising sets at dyadic scales.

A run is a maximal stretch of words with smallest period q that is at least
``MIN_POWER`` periods (and ``MIN_WORDS`` words) long. Periods up to
``SMALL_PERIOD`` are found by comparing words a fixed lag apart. Longer ones are
proposed at the scale c = 2^k with c/2 < q <= c:

* every start of c words has a hash of its context (the c words), built from
  two of half the length;
* a start is synchronising if its hash is the least of some window of c/2
  starts. That depends on nearby words alone, so in a run what is chosen in one
  period is chosen in the next;
* contexts with a period of at most c/4 are left out: they lie in runs that
  smaller scales have found, and these supply their periods;
* two synchronising starts with equal contexts at a distance q with
  c/2 < q <= c propose the period q, which is extended word by word.

No run is missed. One of period q has at least 4q words, so it holds a window of
c/2 starts whose contexts, and those q words further on, lie inside it; contexts
of c >= q words recur in it at multiples of q only; and contexts of period
d <= c/4 cannot fill the window, or the run would have period gcd(q, d).

Documents are independent: the work is one map, some hundred documents at once.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import documents, small_batches

MIN_POWER, MIN_WORDS = 4, 6
SMALL_PERIOD = 4
WORDS_AT_ONCE = 1 << 18          # words of the documents handled together; a longer document is handled alone
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_HALF = np.uint64(31)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)

Run = tuple[int, int, int]       # start, length, period in words


def words_of(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text: just what ``bytes.split`` splits at."""
    return text.split()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _HALF)) * _MIX
    return h ^ (h >> _HALF)


def _reach(v: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (else greatest) of the ``width`` values from each position on; shorter at the end."""
    if width == 1:
        return v
    f, pad = (np.minimum, _TOP) if least else (np.maximum, np.uint64(0))
    n = -(-len(v) // width) * width
    blocks = np.full(n + width, pad, np.uint64)
    blocks[:len(v)] = v
    blocks = blocks.reshape(-1, width)
    ahead = f.accumulate(blocks, axis=1).ravel()                       # from the block's start
    behind = f.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()    # to the block's end
    return f(behind[:len(v)], ahead[width - 1:width - 1 + len(v)])


def synchronising(context: np.ndarray, width: int, left_out: np.ndarray) -> np.ndarray:
    """Positions whose hash is the least of some window of ``width`` positions that holds them."""
    h = np.where(left_out, _TOP, _mixed(context))
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = _reach(h, width, True)[:len(h) - width + 1]                # whole windows only
    padded = np.zeros(len(h) + width - 1, np.uint64)
    padded[width - 1:width - 1 + len(least)] = least
    return np.flatnonzero((_reach(padded, width, False)[:len(h)] == h) & ~left_out)


def _stretch(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """Start and end of the longest stretch around [i, i + q) in which words ``q`` apart are equal."""
    end, step = i, 64
    while end + q < len(w):
        part = w[end:end + step]
        part = part[:len(w) - q - end]
        other = np.flatnonzero(part != w[end + q:end + q + len(part)])
        if len(other):
            end += int(other[0])
            break
        end += len(part)
        step *= 2
    start, step = i, 64
    while start > 0:
        low = max(0, start - step)
        other = np.flatnonzero(w[low:start] != w[low + q:start + q])
        if len(other):
            start = low + int(other[-1]) + 1
            break
        start = low
        step *= 2
    return start, end + q


def _lagged(w: np.ndarray, q: int) -> list[Run]:
    """All stretches with words ``q`` apart equal that are long enough for a run."""
    same = np.concatenate([[False], w[:-q] == w[q:], [False]]) if len(w) > q else np.zeros(1, bool)
    edge = np.flatnonzero(same[1:] != same[:-1])
    start, end = edge[::2], edge[1::2]
    long = end - start + q >= max(MIN_WORDS, MIN_POWER * q)
    return [(a, b - a + q, q) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]


def _proposals(context: np.ndarray, chosen: np.ndarray, c: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, distance) of chosen pairs with equal contexts and a distance above c/2, at most c."""
    for t in range(1, len(chosen)):
        at, apart = chosen[:-t], chosen[t:] - chosen[:-t]
        close = apart <= c
        if not close.any():
            return
        pair = np.flatnonzero(close & (apart > c // 2))
        pair = pair[context[at[pair]] == context[chosen[t:][pair]]]
        if len(pair):
            yield at[pair], apart[pair]


def stretches(w: np.ndarray, reach: Callable[[int], int]) -> list[Run]:
    """Every run of the word hashes ``w``, several documents one after the other, with its smallest period.

    ``reach(n)`` is the number of leading words that belong to documents of at
    least ``n`` words: documents come longest first, and a scale looks at those
    that are long enough for its periods.
    """
    found: dict[tuple[int, int], int] = {}

    def add(start, length, q):
        found[start, start + length] = min(q, found.get((start, start + length), q))

    for q in range(1, SMALL_PERIOD + 1):
        for r in _lagged(w[:reach(max(MIN_WORDS, MIN_POWER * q))], q):
            add(*r)
    context, c = w, 1
    while True:
        shorter = len(context) - c
        if shorter <= 0:
            break
        context = _mixed(context[:shorter] * _ODD + context[c:])       # the hash of 2c words
        c *= 2
        if c <= SMALL_PERIOD:
            continue
        n = reach(MIN_POWER * (c // 2 + 1))
        if not n:
            break
        context = context[:n]
        left_out = np.zeros(len(context) + 1, np.int32)
        for (start, end), q in found.items():
            if 4 * q <= c <= end - start and start < len(context):
                left_out[start] += 1
                left_out[min(end - c + 1, len(context))] -= 1
        chosen = synchronising(context, c // 2, left_out.cumsum()[:-1] > 0)
        pairs = list(_proposals(context, chosen, c))
        if not pairs:
            continue
        at, q = (np.concatenate(p) for p in zip(*pairs, strict=True))
        by = np.lexsort((at, q))
        last, end = 0, -1
        for i, d in zip(at[by].tolist(), q[by].tolist(), strict=True):
            if d == last and i + d <= end:
                continue
            start, end = _stretch(w[:n], i, d)
            last = d
            if end - start >= max(MIN_WORDS, MIN_POWER * d):
                add(start, end - start, d)
    return [(a, b - a, q) for (a, b), q in found.items()]


def runs_of(docs: list[list[bytes]]) -> list[list[Run]]:
    """The runs of every list of words, by start, then period."""
    order = sorted(range(len(docs)), key=lambda k: -len(docs[k]))
    sizes = np.array([len(docs[k]) for k in order], np.int64)
    ends = sizes.cumsum()
    total = int(ends[-1]) if len(ends) else 0
    # the document's number is part of a word's hash: no word equals one of another document
    w = np.fromiter((hash(x) for k in order for x in docs[k]), np.int64, total).view(np.uint64)
    w = _mixed(w + np.repeat(np.arange(1, len(order) + 1, dtype=np.uint64) * _ODD, sizes))

    def reach(n: int) -> int:
        k = int(np.searchsorted(-sizes, -n, side="right"))
        return int(ends[k - 1]) if k else 0

    out: list[list[Run]] = [[] for _ in docs]
    for start, length, q in stretches(w, reach):
        k = int(np.searchsorted(ends, start, side="right"))
        first = start - int(ends[k] - sizes[k])
        out[order[k]].append((first, length, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    return [words[i] for i in np.flatnonzero(drop.cumsum()[:-1] == 0).tolist()]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest exact length/period; ties go to the smallest start, then period."""
    best = None
    for r in sorted(runs, key=lambda x: (x[0], x[2])):
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _groups(docs: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``WORDS_AT_ONCE`` words."""
    first = held = 0
    for k, d in enumerate(docs):
        if held and held + len(d) > WORDS_AT_ONCE:
            yield first, k
            first, held = k, 0
        held += len(d)
    if first < len(docs):
        yield first, len(docs)


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, runs, collapsed) of every row: runs as (start, length, period) by start, then period;
    collapsed is the text's words joined by one space, without the repeats that runs hold.

    ``rewrite(id, words)`` may change the words first. Whole texts; a null or
    empty text has no words, no runs and an empty collapsed text; repeated rows
    and null ids stay, one output row each; other columns are not read.
    """
    run_type = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("runs", run_type),
                           T.StructField("collapsed", T.StringType())])
    arrow = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            docs = [words_of(t or b"") for t in b.column(1).cast(pa.binary()).to_pylist()]
            if rewrite is not None:
                docs = [rewrite(i, d) for i, d in zip(b.column(0).to_pylist(), docs, strict=True)]
            for first, end in _groups(docs):
                runs = runs_of(docs[first:end])
                kept = [b" ".join(collapsed(d, r)).decode() for d, r in zip(docs[first:end], runs, strict=True)]
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, end - first), pa.array(rows, arrow), pa.array(kept, pa.string())], schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with, in every tenth document by its id's CRC-32, a periodic rest from some word on."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * (-(-(n - a) // p)))[:n - a]


def digests(runs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, strongest run, digests) of ``find_runs``'s rows."""
    schema = T.StructType([T.StructField(id_col, runs.schema[id_col].dataType)]
                          + [T.StructField(n, T.LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")]
                          + [T.StructField(n, T.StringType()) for n in ("runs_sha256", "collapsed_sha256")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = [[(r["start"], r["length"], r["period"]) for r in rs] for rs in b.column(1).to_pylist()]
            best = [strongest(rs) for rs in lists]
            cols = [[len(rs) for rs in lists], *([r and r[k] for r in best] for k in range(3)),
                    [r and 1000 * r[1] // r[2] for r in best]]
            listed = ["".join(f"{s},{n},{q}\n" for s, n, q in rs) for rs in lists]
            texts = b.column(2).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols),
                 pa.array([hashlib.sha256(s.encode()).hexdigest() for s in listed], pa.string()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], schema.names)

    return runs.mapInArrow(run, schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every periodic run of words of every whole document, and the documents without the repeats."""
    return digests(find_runs(documents(spark, sf_dir), rewrite=periodic_tail))
