import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from utterflow.llm import periodic_runs as R
from utterflow.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


def slow(w):
    """Every run by trying every period and every place."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] == w[i + q]:
                s = i
                while i + q < len(w) and w[i] == w[i + q]:
                    i += 1
                if i - s + q >= max(6, 4 * q):
                    found.setdefault((s, i - s + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda x: (x[0], x[2]))


def random_document(rnd):
    n, letters = rnd.randrange(300), rnd.choice([1, 2, 3, 60])
    d = [str(rnd.randrange(letters)).encode() for _ in range(n)]
    for _ in range(rnd.randrange(4) if n else 0):        # planted repeats, also within one another
        a = rnd.randrange(n)
        p = rnd.randrange(1, max(2, (n - a) // 3 + 1))
        for i in range(a, min(n, a + int(p * rnd.uniform(2, 9)))):
            d[i] = d[a + (i - a) % p]
    if rnd.random() < 0.3:                               # periods that are nearly periodic themselves
        d = ([b"a", b"b"] * rnd.randrange(1, 20) + [b"a"] * rnd.randrange(2)) * rnd.randrange(1, 9) + d
    return d


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    docs = [random_document(rnd) for _ in range(150)]
    assert R.runs_of(docs) == [slow(d) for d in docs]


def test_fibonacci_words_and_whole_powers():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 600:
        a, b = b, b + a
    powers = [[b"x", b"y", b"z"] * 40, [b"w"] * 6, [b"w"] * 5, [b"p", b"q"] * 4, [b"p", b"q"] * 3 + [b"p"]]
    docs = [b, *powers, [str(i).encode() for i in range(97)] * 4]
    assert R.runs_of(docs) == [slow(d) for d in docs]
    assert R.runs_of(powers) == [[(0, 120, 3)], [(0, 6, 1)], [], [(0, 8, 2)], []]


def test_synchronising_positions_are_local_and_dense():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2 ** 63, 500).astype(np.uint64)
    none = np.zeros(500, bool)
    chosen = R.synchronising(x, 16, none)
    assert (np.diff(chosen) <= 16).all()
    h = R._mixed(x)
    assert set(chosen) == {s + int(np.argmin(h[s:s + 16])) for s in range(500 - 15)}
    twice = R.synchronising(np.concatenate([x, x]), 16, np.zeros(1000, bool))
    assert set(chosen[(chosen >= 15) & (chosen < 485)] + 500) <= set(twice)     # the same words choose the same places


def slow_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def slow_row(doc_id, text):
    w = slow_words(text)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = slow(w)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def test_query_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 12000").select("doc_id", "text").collect()
    got = {r[0]: tuple(r) for r in LLM_QUERIES["op13_periodic_runs"](spark, SF).collect()}
    want = {r.doc_id: slow_row(r.doc_id, r.text) for r in docs}
    assert {i: got[i] for i in want} == want and sum(w[1] > 0 for w in want.values()) >= 10


def test_odd_rows(spark):
    odd = "a b \x1c a b \x1c a b \x1c a b \x1c\v\fc"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, odd), (None, "k " * 7), (5, "one"), (6, "é " * 6), (6, "é " * 6)]
    schema = "doc_id long, text string, runs int, collapsed string, w string"
    df = spark.createDataFrame([(*r, 1, "", "") for r in rows], schema)
    got = R.find_runs(df).collect()
    key = lambda r: (r[0] or 0, r[2])
    assert sorted([(r[0], [tuple(x) for x in r[1]], r[2]) for r in got], key=key) == sorted([
        (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 8, 2)], "a b \x1c c"), (None, [(0, 7, 1)], "k"), (5, [], "one"),
        (6, [(0, 6, 1)], "é"), (6, [(0, 6, 1)], "é")], key=key)
    assert R.digests(R.find_runs(df.limit(0), rewrite=R.periodic_tail)).count() == 0
    none = R.digests(R.find_runs(df.where("doc_id = 1"), rewrite=R.periodic_tail)).first()
    assert tuple(none)[1:6] == (0, None, None, None, None) and none.collapsed_sha256 == hashlib.sha256(b"").hexdigest()


def test_a_very_long_text(spark):
    period = [f"w{i}" for i in range(40_000)]
    text = " ".join(["head"] + period * 5 + ["ab"] * 100_000)
    row = R.find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in row.runs] == [(1, 200_000, 40_000), (200_001, 100_000, 1)]
    assert row.collapsed == " ".join(["head", *period, "ab"])
