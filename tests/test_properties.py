"""Property tests: Spark expressions vs plain-Python renderings of the same steps."""

import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from utterflow.functions import text
from utterflow.operators import arrays, mix, reconcile
from utterflow.plans import catalog as C
from utterflow.plans import fixtures as fx

WS = [chr(c) for c in range(0x110000) if chr(c).isspace()]
ALPHABET = (list("abcXYZ019 -<>[]\\'\".,!?") + ["ạ", "Ẫ", "đ", "Ư", "ß", "é", "﻿", "\r", "\n", "\t"] + WS
            + ["…", "«", "»", "‐", "¿", "·", "؝", "⹓"])
texts = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=60)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def py_normalize(s):
    s = s.lower()
    s = re.sub(r"[<\[][^>\]]*[>\]]", "", s)
    s = re.sub(r"\s\s+", " ", s)
    s = s.strip()
    s = "".join(c for c in s if not unicodedata.category(c).startswith("P"))
    return [w for w in s.split(" ") if w]


def py_clean(s):
    s = re.sub(" ?- ?", " ", s)
    s = re.sub("\n+", " ", s)
    s = re.sub("\r+", " ", s)
    s = re.sub(" +", " ", s)
    s = s.replace("\\", "").replace(chr(65279), "")
    return s.strip()


def run(spark, values, col):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x string")
    return [r.y for r in df.select("i", col.alias("y")).orderBy("i").collect()]


@SETTINGS
@given(texts)
def test_normalizer_matches_python(spark, values):
    assert run(spark, values, text.normalize_words(F.col("x"))) == [py_normalize(v) for v in values]


@SETTINGS
@given(texts)
def test_cleaner_matches_python(spark, values):
    assert run(spark, values, text.clean_transcript(F.col("x"))) == [py_clean(v) for v in values]


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 50), max_size=12), min_size=1, max_size=40), st.integers(1, 7))
def test_pad_then_unpad_is_identity(spark, labels, b):
    df = spark.createDataFrame([(i, i // b, l) for i, l in enumerate(labels)], "i long, batch long, labels array<int>")
    p = arrays.pad_labels(df)
    rows = p.select("i", "batch", "labels", F.filter("labels", lambda x: x != -100).alias("u")).orderBy("i").collect()
    longest = {}
    for r in rows:
        longest[r.batch] = max(longest.get(r.batch, 0), len(labels[r.i]))
    for r in rows:
        assert r.u == labels[r.i] and len(r.labels) == longest[r.batch]


def test_listed_existing_and_complement_partition_files(spark):
    files = fx.files(spark, SF_SMALL)
    inter = reconcile.listed_existing(fx.listed(spark, SF_SMALL), files)
    rest = reconcile.complement(files, inter)
    a = {r.path for r in inter.collect()}
    b = {r.path for r in rest.collect()}
    assert not (a & b) and (a | b) == {r.path for r in files.collect()}


def test_rank_slices_cover_each_batch(spark):
    r = C.QUERIES["rank_slices"](spark, SF_SMALL).collect()
    per = {}
    for x in r:
        per.setdefault((x.pos // C.RANK_BATCH, x.rank), 0)
        per[(x.pos // C.RANK_BATCH, x.rank)] += 1
    full = len(r) // C.RANK_BATCH
    assert all(per[(b, k)] == C.RANK_BATCH // C.RANK_N for b in range(full) for k in range(C.RANK_N))


def test_concat_count_is_sum_of_inputs(spark):
    u = fx.utt(spark, SF_SMALL)
    parts = [u.where(F.col("lang") == l) for l in ("en", "fr", "de", "es")]
    assert mix.concat_sources(parts).count() == sum(p.count() for p in parts) == u.count()
