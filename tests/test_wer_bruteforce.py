"""Every WER key against an independent implementation over the whole sf0.01 fixture.

Normalization: plain Python (the steps of X16). Edit distance: a numpy dynamic
program, row by row, with the horizontal recurrence as a running minimum:
D[i][j] = j + min_{k<=j}(E[k] - k), where E is the diagonal/vertical candidate.
"""

import re
import unicodedata

import numpy as np
import pytest

from conftest import SF_CHECK
from utterflow.plans import catalog as C
from utterflow.plans import fixtures as fx


def py_normalize(s):
    if s is None:
        return []
    s = s.lower()
    s = re.sub(r"[<\[][^>\]]*[>\]]", "", s)
    s = re.sub(r"\s\s+", " ", s)
    s = s.strip()
    s = "".join(c for c in s if not unicodedata.category(c).startswith("P"))
    return [w for w in s.split(" ") if w]


def dp_distance(a, b):
    if not a:
        return len(b)
    if not b:
        return len(a)
    ids = {}
    x = np.array([ids.setdefault(w, len(ids)) for w in a])
    y = np.array([ids.setdefault(w, len(ids)) for w in b])
    j = np.arange(len(y) + 1)
    row = j.copy()
    for i, xi in enumerate(x, 1):
        e = np.empty_like(row)
        e[0] = i
        e[1:] = np.minimum(row[:-1] + (y != xi), row[1:] + 1)
        row = j + np.minimum.accumulate(e - j)
    return int(row[-1])


@pytest.fixture(scope="module")
def truth(spark):
    rows = fx.pairs(spark, SF_CHECK).select("split", "utt_id", "ref", "hyp").collect()
    out = {}
    for r in rows:
        rw, hw = py_normalize(r.ref), py_normalize(r.hyp)
        out[r.utt_id] = (r.split, len(rw), len(hw), dp_distance(rw, hw))
    return out


def test_wer_pairs_every_pair(spark, truth):
    got = {r.utt_id: (r.split, r.ref_words, r.hyp_words, r.edits) for r in C.QUERIES["wer_pairs"](spark, SF_CHECK).collect()}
    assert got == truth


def test_wer_by_split_corpus_and_gate(spark, truth):
    per = {}
    for split, nr, _, e in truth.values():
        a = per.setdefault(split, [0, 0, 0, 0])
        a[0] += 1; a[1] += e; a[2] += nr; a[3] += nr == 0
    by = {r.split: r for r in C.QUERIES["wer_by_split"](spark, SF_CHECK).collect()}
    for split, (n, e, w, z) in per.items():
        r = by[split]
        assert (r.n_pairs, r.edits, r.ref_words, r.n_empty_ref) == (n, e, w, z)
        assert r.wer == pytest.approx(100 * e / w)
    c = C.QUERIES["wer_corpus"](spark, SF_CHECK).first()
    assert (c.edits, c.ref_words) == (sum(v[1] for v in per.values()), sum(v[2] for v in per.values()))
    gate = {r.split: r.status for r in C.QUERIES["wer_gate"](spark, SF_CHECK).collect()}
    assert gate == {s: ("suspicious" if s == "validation" else "ok") for s in per}      # validation is predicted without an error
    samples = C.QUERIES["wer_gate_samples"](spark, SF_CHECK).collect()
    assert len(samples) == 10 and all(r.split == "validation" and r.reference == r.prediction for r in samples)


def test_stream_wer_matches(spark, truth):
    s = {r.split: (r.edits, r.ref_words) for r in C.QUERIES["stream_wer"](spark, SF_CHECK).collect()}
    per = {}
    for split, nr, _, e in truth.values():
        a = per.setdefault(split, [0, 0])
        a[0] += e; a[1] += nr
    assert s == {k: tuple(v) for k, v in per.items()}


def test_wer_from_ids_matches(spark):
    u = fx.utt(spark, SF_CHECK).select("split", "utt_id", "text").collect()
    vocab = {c for r in u if r.split == "train" for c in r.text if c != " "}
    keep = lambda t: "".join(c for c in t if c == " " or c in vocab)
    per = {}
    hyps = {r.utt_id: r.hyp for r in fx.pairs(spark, SF_CHECK).select("utt_id", "hyp").collect()}
    for r in u:
        ref, hyp = py_normalize(keep(r.text)), py_normalize(keep(hyps[r.utt_id]))
        a = per.setdefault(r.split, [0, 0])
        a[0] += dp_distance(ref, hyp); a[1] += len(ref)
    got = {r.split: (r.edits, r.ref_words) for r in C.QUERIES["wer_from_ids"](spark, SF_CHECK).collect()}
    assert got == {k: tuple(v) for k, v in per.items()}
