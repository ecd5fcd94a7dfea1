"""Word-level edit distance, bit-parallel (Myers 1999 / Hyyro 2001).

Spark's built-in ``levenshtein`` is an O(n*m) cell-by-cell loop; the
bit-vector formulation processes 64 cells per machine word. It is used through an
Arrow-batched pandas UDF; the pure-JVM path stays available (``method="native"``).

Pairs run in lockstep, first in bands around the matrix's diagonals (Ukkonen
1985), which double while a distance exceeds its band: one NumPy step moves the
bands of a group of pairs one word of their shorter sides on. Pairs too unlike
for a band take the whole matrix: every 64 words of a pair's longer side are a
lane; a pair's second lane is a word behind its first, and so on, so what a lane
carries over is there when the next one needs it. Groups too small for lockstep,
such as one pair of 20,000 words, take Python's integers as bit vectors, one
word at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


LANES = 1 << 12                  # 64-bit blocks in a group
TABLE_BYTES = 32 << 20           # bound on a group's table of word positions
PIECE_CHARS = 4 << 20            # text split into words at once
# What a step costs, in the time that a step over one pair's integers takes besides its length
_STEP, _LANE, _LONG = 14.0, 0.02, 0.02


def trimmed(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """The pair, longer side first, without common beginning and end."""
    if len(a) < len(b):
        a, b = b, a
    start, end = 0, len(b)
    while start < end and a[start] == b[start]:
        start += 1
    cut = len(a) - len(b)    # a common end lies at the same distance from both ends
    while end > start and a[end - 1 + cut] == b[end - 1]:
        end -= 1
    return a[start:end + cut], b[start:end]


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Minimum substitutions + deletions + insertions turning ``a`` into ``b``."""
    a, b = trimmed(a, b)
    return _alone(a, b) if len(b) else len(a)


def _alone(a: Sequence, b: Sequence) -> int:
    """The distance of one pair: in a band that doubles while the distance exceeds it, then in the whole matrix."""
    margin = 8 + len(b) // 16
    while 2 * (len(a) - len(b) + 2 * margin) < len(a):
        if (found := _banded(a, b, margin)) is not None:
            return found
        margin *= 2
    return _one(a, b)


def _banded(a: Sequence, b: Sequence, margin: int) -> int | None:
    """The distance of one pair if no cheapest path leaves the diagonals from -margin to len(a) - len(b) + margin,
    else None. The bit vectors hold the band's rows only and move down a row with every word (Hyyro 2003)."""
    more = len(a) - len(b)
    most = more + 2 * margin + 1             # a path that leaves the band costs more
    mask = (1 << most) - 1
    at = 1 << (more + margin)                # the diagonal that ends in the last cell
    peq: dict = {}
    for i, w in enumerate(a, margin):
        peq[w] = peq.get(w, 0) | (1 << i)
    pv, mv, score = mask >> margin << margin, 0, more
    for j, w in enumerate(b):
        d = mv
        if eq := peq.get(w):
            eq = eq >> j & mask
            d |= (((eq & pv) + pv ^ pv) | eq) & mask
        if not d & at:
            score += 1
            if score > most:
                return None
        ph = (d | pv) ^ mask | mv
        mh = d & pv
        d >>= 1
        pv = (d | ph) ^ mask | mh
        mv = d & ph
    return score


def _one(a: Sequence, b: Sequence) -> int:
    """The distance of one pair, with integers of any length as bit vectors over ``a``."""
    m = len(a)
    peq: dict = {}
    for i, w in enumerate(a):
        peq[w] = peq.get(w, 0) | (1 << i)
    mask = (1 << m) - 1
    high = 1 << (m - 1)
    pv, mv, score = mask, 0, m
    for w in b:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & mask)
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ((ph << 1) | 1) & mask
        mh = (mh << 1) & mask
        pv = mh | (~(xv | ph) & mask)
        mv = ph & xv
    return score


def _lockstep(pairs: list[tuple[Sequence, Sequence]]) -> np.ndarray:
    """Distances of pairs with no empty side; best in the order of their numbers of steps."""
    one, full = np.uint64(1), ~np.uint64(0)
    n = np.array([len(a) for a, _ in pairs])
    m = np.array([len(b) for _, b in pairs])
    blocks = (n + 63) // 64
    end = np.maximum.accumulate(m + blocks - 1)          # steps after which a pair and those before it are done
    first = np.concatenate([[0], blocks.cumsum()])
    most = int(blocks.max())
    # words as numbers from 1 in each pair; the table holds every lane's bits of every number, 0 for unknown words
    tables, symbols, at = [], [np.zeros(most, np.int64)], 0
    for k, (a, b) in enumerate(pairs):
        known: dict = {}
        numbers = np.fromiter((known.setdefault(w, len(known) + 1) for w in a), np.int64, len(a))
        table = np.zeros((len(known) + 1, int(blocks[k])), np.uint64)
        place = np.arange(len(a))
        np.bitwise_or.at(table, (numbers, place >> 6), one << (place & 63).astype(np.uint64))
        tables.append(table.ravel())
        symbols.append(at + blocks[k] * np.fromiter((known.get(w, 0) for w in b), np.int64, len(b)))
        at += table.size
    flat = np.concatenate([*tables, np.zeros(most, np.uint64)])      # a lane that has not begun, or is done, may look beyond
    said = np.concatenate([*symbols, np.zeros(int(end[-1]) + 1, np.int64)])
    begun = most + np.concatenate([[0], m.cumsum()[:-1]])
    pair = np.repeat(np.arange(len(pairs)), blocks)
    block = np.arange(int(first[-1])) - first[pair]
    word = begun[pair] - block                           # place of a lane's word in ``said`` at step 0
    last = first[1:] - 1
    high = np.full(len(pair), np.uint64(63))
    high[last] = ((n - 1) & 63).astype(np.uint64)
    head = block == 0
    pv, mv = np.full(len(pair), full), np.zeros(len(pair), np.uint64)
    carry_p, carry_m = np.zeros(len(pair) + 1, np.uint64), np.zeros(len(pair) + 1, np.uint64)
    score = n.astype(np.int64)
    for t in range(int(end[-1])):
        done = int(np.searchsorted(end, t, side="right"))
        lo = int(first[done])
        p, v = pv[lo:], mv[lo:]
        # what the lane before carried over for this word; a pair's first lane counts one more a word
        in_p, in_m = carry_p[lo:-1].copy(), carry_m[lo:-1].copy()
        in_p[head[lo:]], in_m[head[lo:]] = 1, 0
        eq = flat.take(said.take(word[lo:] + t) + block[lo:])
        xv = eq | v
        eq |= in_m
        xh = eq & p
        xh += p
        xh ^= p
        xh |= eq
        mh = p & xh
        xh |= p
        ph = v | ~xh
        np.right_shift(ph, high[lo:], out=carry_p[lo + 1:])
        np.right_shift(mh, high[lo:], out=carry_m[lo + 1:])
        carry_p[lo + 1:] &= one
        carry_m[lo + 1:] &= one
        ph <<= one
        ph |= in_p
        mh <<= one
        mh |= in_m
        np.bitwise_and(ph, xv, out=v)
        xv |= ph
        np.bitwise_or(mh, ~xv, out=p)
        if t < most:                                     # lanes that have not begun yet
            p[block[lo:] > t], v[block[lo:] > t] = full, 0
        now = slice(done, None)
        change = carry_p[last[now] + 1].view(np.int64) - carry_m[last[now] + 1].view(np.int64)
        if t < most or done < len(pairs):
            change[(blocks[now] - 1 > t) | (blocks[now] - 1 + m[now] <= t)] = 0
        score[now] += change
    return score


def _bands(pairs: list[tuple[Sequence, Sequence]], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """``_banded`` of pairs in lockstep, whose bands have ``wide`` 64-bit words: scores, and the largest that hold.

    Pairs come by falling length of their shorter sides. Column k of a matrix is pair k; with every step all bands
    move down a row, so the words of a band are cut from the table at the same bit for all pairs.
    """
    one, full = np.uint64(1), ~np.uint64(0)
    m = np.array([len(b) for _, b in pairs])
    more = np.array([len(a) for a, _ in pairs]) - m
    margin = (64 * wide - 1 - more) // 2
    said = np.zeros((int(m[0]), len(pairs)), np.int64)   # where a word's row begins in the table
    tables, start = [], 0
    for k, (a, b) in enumerate(pairs):
        known = dict(zip(dict.fromkeys(a), range(1, len(a) + 1)))
        row = _row(len(b), wide)
        table = np.zeros((len(known) + 1) * row, np.uint64)
        seen = min(len(a), 64 * row - int(margin[k]))
        place = np.arange(int(margin[k]), int(margin[k]) + seen)
        numbers = np.fromiter(map(known.__getitem__, a[:seen]), np.int64, seen)
        np.add.at(table, numbers * row + (place >> 6), one << (place & 63).astype(np.uint64))
        tables.append(table)
        said[:len(b), k] = start + row * np.fromiter(map(known.get, b, repeat(0)), np.int64, len(b))
        start += table.size
    flat = np.concatenate(tables)
    at = more + margin
    at_word, at_bit = at >> 6, (at & 63).astype(np.uint64)
    word = np.arange(wide + 1)[:, None]
    bits = one << word[:-1].view(np.uint64)
    begin = np.clip(margin - 64 * word[:-1], 0, 64)
    pv = np.where(begin < 64, full << np.minimum(begin, 63).astype(np.uint64), np.uint64(0))
    mv = np.zeros_like(pv)
    score = more.astype(np.int64)
    column = np.arange(len(pairs))
    alive = len(pairs)
    for j in range(int(m[0])):
        if m[alive - 1] <= j:
            alive = int(np.searchsorted(-m, -j))         # pairs that have more than j words
            pv, mv = pv[:, :alive].copy(), mv[:, :alive].copy()
        cut = flat.take(said[j, :alive] + (word + (j >> 6)))
        r = np.uint64(j & 63)
        eq = cut[:-1]
        if r:
            eq = eq >> r
            eq |= cut[1:] << (np.uint64(64) - r)
        d = eq & pv
        total = d + pv
        if wide > 1:
            # a band's carries at once: a bit a word for those that carry and those that pass a carry on
            carry = np.bitwise_or.reduce((total < d) * bits, axis=0) << one
            on = np.bitwise_or.reduce((total == full) * bits, axis=0)
            carry += on
            carry ^= on
            total += carry >> word[:-1].view(np.uint64) & one
        total ^= pv
        total |= eq
        total |= mv
        d = total
        score[:alive] += ((d[at_word[:alive], column[:alive]] >> at_bit[:alive]) & one ^ one).view(np.int64)
        ph = d | pv
        np.invert(ph, out=ph)
        ph |= mv
        pv &= d                                          # now the words that go down
        down = d >> one
        if wide > 1:
            down[:-1] |= d[1:] << np.uint64(63)
        mv = down & ph
        down |= ph
        np.invert(down, out=down)
        pv |= down
    return score, more + 2 * margin


def _row(steps: int, wide: int) -> int:
    """Words of a row of the table of ``_bands``: all that a band sees on its way down."""
    return (steps >> 6) + wide + 1


def distances(pairs: Iterable[tuple[Sequence, Sequence]]) -> np.ndarray:
    """``edit_distance`` of every pair, similar ones in lockstep: in bands that double, then in the whole matrix."""
    pairs = [trimmed(a, b) for a, b in pairs]
    out = np.array([len(a) if not len(b) else 0 for a, b in pairs], dtype=np.int64)
    todo = {k: 8 + len(b) // 16 for k, (_, b) in enumerate(pairs) if len(b)}
    whole = []
    while todo:
        wide = {k: -(-(len(pairs[k][0]) - len(pairs[k][1]) + 2 * margin + 1) // 64) for k, margin in todo.items()}
        whole += [k for k, w in wide.items() if w > 1 and 128 * w > len(pairs[k][0])]
        for k in whole:
            todo.pop(k, None)
        order = sorted(todo, key=lambda k: (wide[k], -len(pairs[k][1])))
        again, at = {}, 0
        while at < len(order):
            group, table, w = [], 0, wide[order[at]]
            for k in order[at:]:
                size = 8 * (len(pairs[k][0]) + 1) * _row(len(pairs[k][1]), w)
                if group and (wide[k] != w or (len(group) + 1) * w > LANES or table + size > TABLE_BYTES
                              or 2 * len(pairs[k][1]) + 32 < len(pairs[group[0]][1])):
                    break
                group.append(k)
                table += size
            at += len(group)
            steps = [len(pairs[k][1]) for k in group]
            if w < 64 and steps[0] * (_STEP + _LANE * w * len(group)) < sum(steps) * (1 + _LONG * w):
                found, most = _bands([pairs[k] for k in group], w)
                out[group] = found
                again.update((k, 2 * todo[k]) for k, x, y in zip(group, found, most, strict=True) if x > y)
            else:
                out[group] = [_alone(*pairs[k]) for k in group]
        todo = again
    if whole:
        out[whole] = _whole([pairs[k] for k in whole])
    return out


def _whole(pairs: list[tuple[Sequence, Sequence]]) -> np.ndarray:
    """Distances of pairs with no empty side in their whole matrices, similar ones in lockstep."""
    out = np.zeros(len(pairs), np.int64)
    todo = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]) + len(pairs[k][0]) // 64)
    at = 0
    while at < len(todo):
        group, lanes, table = [], 0, 0
        for k in todo[at:]:
            a, b = pairs[k]
            blocks = -(-len(a) // 64)
            if group and (lanes + blocks > LANES or table + 8 * blocks * len(a) > TABLE_BYTES or len(b) > 2 * len(pairs[group[0]][1]) + 32):
                break
            group.append(k)
            lanes, table = lanes + blocks, table + 8 * blocks * len(a)
        at += len(group)
        steps = len(pairs[group[-1]][1]) + max(-(-len(pairs[k][0]) // 64) for k in group)
        alone = sum(len(pairs[k][1]) * (1 + _LONG * len(pairs[k][0]) / 64) for k in group)
        if steps * (_STEP + _LANE * lanes) < alone:
            out[group] = _lockstep([pairs[k] for k in group])
        else:
            out[group] = [_alone(*pairs[k]) for k in group]
    return out


def reference_distance(a: Sequence, b: Sequence) -> int:
    """Plain dynamic program, used by tests as the independent implementation."""
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y))
        prev = cur
    return prev[-1]


def text_distances(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """``edit_distance`` of the words, between blanks, of every pair of texts.

    Pairs of similar length are split into words together, ``PIECE_CHARS`` of text at most or a single pair: words
    take some ten times the memory of their text, and a batch has up to 10,000 pairs.
    """
    out = np.zeros(len(pairs), dtype=np.int64)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][0]) + len(pairs[k][1]))
    piece, chars = [], 0
    for k in order:
        size = len(pairs[k][0]) + len(pairs[k][1])
        if piece and chars + size > PIECE_CHARS:
            out[piece] = distances((pairs[i][0].split(" "), pairs[i][1].split(" ")) for i in piece)
            piece, chars = [], 0
        piece.append(k)
        chars += size
    if piece:
        out[piece] = distances((pairs[i][0].split(" "), pairs[i][1].split(" ")) for i in piece)
    return out


@F.pandas_udf(T.LongType())
def _edits_udf(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    sent = ref.notna().to_numpy()
    out = np.zeros(len(ref), dtype=np.int64)
    out[sent] = text_distances(list(zip(ref[sent], hyp[sent], strict=True)))
    return pd.Series(out)


def word_edit_distance(ref: Column, hyp: Column, n: Column, m: Column) -> Column:
    """Column of edit distances between two columns of words joined by one blank, ``n`` and ``m`` of them.

    Equal and empty sides are settled in the JVM and not sent to Python; the
    others travel as one string a side, which Arrow moves faster than arrays.
    """
    settled = (n == 0) | (m == 0) | (ref == hyp)
    edits = _edits_udf(F.when(~settled, ref), F.when(~settled, hyp))
    return F.when(ref == hyp, F.lit(0)).when((n == 0) | (m == 0), F.greatest(n, m)).otherwise(edits).cast("bigint")
