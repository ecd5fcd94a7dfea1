import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from utterflow.functions.editdistance import edit_distance, reference_distance
from utterflow.operators import score
from utterflow.plans import fixtures as fx
from utterflow.plans.evaluate import evaluate


def pairs_df(spark, rows):
    return spark.createDataFrame([("t", i, r, h) for i, (r, h) in enumerate(rows)],
                                 "split string, utt_id long, ref string, hyp string")


EDGE = [("a b c d", "a x c", 2), ("a b", "a b", 0), ("", "x y", 2), ("w", "", 1), ("", "", 0),
        ("Xin chào, BẠN!", "xin chao ban", 2), (None, "x y", 2), ("a b", None, 2)]


@pytest.mark.parametrize("method", ["bitparallel", "native"])
def test_word_edits_edge_rows(spark, method):
    e = score.word_edits(pairs_df(spark, [(r, h) for r, h, _ in EDGE]), method=method)
    got = {r.utt_id: r.edits for r in e.collect()}
    assert [got[i] for i in range(len(EDGE))] == [x for _, _, x in EDGE]


@pytest.mark.parametrize("method", ["bitparallel", "native"])
def test_word_edits_random_against_dynamic_program(spark, method):
    rnd = random.Random(7)
    rows = []
    for _ in range(300):
        v = rnd.randint(1, 8)
        r = [f"w{rnd.randint(0, v)}" for _ in range(rnd.randint(0, 40))]
        h = [f"w{rnd.randint(0, v)}" for _ in range(rnd.randint(0, 40))]
        rows.append((" ".join(r), " ".join(h)))
    e = score.word_edits(pairs_df(spark, rows), method=method, spread_key="utt_id")
    got = {r.utt_id: r.edits for r in e.collect()}
    for i, (r, h) in enumerate(rows):
        assert got[i] == reference_distance(r.split(), h.split())


def test_bitparallel_matches_dynamic_program_long():
    rnd = random.Random(3)
    for _ in range(20):
        a = [rnd.randint(0, 30) for _ in range(rnd.randint(100, 400))]
        b = [rnd.randint(0, 30) for _ in range(rnd.randint(100, 400))]
        assert edit_distance(a, b) == reference_distance(a, b)


def test_corpus_wer_is_micro_average(spark):
    e = spark.createDataFrame([("t", 1, 1, 1, 1), ("t", 2, 9, 9, 0)],
                              "split string, utt_id long, ref_words long, hyp_words long, edits long")
    w = score.corpus_wer(e).first()
    assert w.wer == pytest.approx(10.0)
    empty = spark.createDataFrame([("t", 1, 0, 2, 2)], "split string, utt_id long, ref_words long, hyp_words long, edits long")
    assert score.corpus_wer(empty).first().wer is None


def test_wer_gate(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (99.9,), (100.0,), (None,)], "wer double")
    got = [r.status for r in score.wer_gate(df).collect()]
    assert got == ["suspicious", "ok", "ok", "suspicious", "suspicious"]


def test_whole_fixture_against_dynamic_program(spark):
    """Brute force on the small fixture: every pair's edits vs a plain DP."""
    from utterflow.functions.text import normalize_words
    p = fx.pairs(spark, SF_SMALL)
    e = {r.utt_id: r for r in score.word_edits(p).collect()}
    w = p.select("utt_id", normalize_words("ref").alias("r"), normalize_words("hyp").alias("h")).collect()
    short = [x for x in w if len(x.r) * len(x.h) <= 250_000]
    assert len(short) > 150
    for x in short:
        assert e[x.utt_id].edits == reference_distance(x.r, x.h)
        assert e[x.utt_id].ref_words == len(x.r)
    native = {r.utt_id: r.edits for r in score.word_edits(p, method="native").collect()}
    assert native == {k: v.edits for k, v in e.items()}


def test_pred_truth_match_and_row_gate(spark):
    t = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "split string, utt_id long")
    p = spark.createDataFrame([("a", 1), ("b", 3), ("b", 4)], "split string, utt_id long")
    got = {r.split: (r.truth_only, r.pred_only, r.matched, r.ok) for r in score.pred_truth_match(t, p).collect()}
    assert got == {"a": (1, 0, 1, False), "b": (0, 1, 1, False)}
    twice = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2)], "split string, utt_id long")
    row = score.pred_truth_match(t.where("split = 'a'"), twice).first()
    assert (row.truth_only, row.pred_only, row.matched, row.repeated, row.ok) == (0, 0, 2, 1, False)
    row = score.pred_truth_match(twice, t.where("split = 'a'")).first()
    assert (row.matched, row.repeated, row.ok) == (2, 1, False)
    assert score.pred_truth_match(t, t).where("not ok or repeated > 0").count() == 0
    exp = spark.createDataFrame([("a", 2), ("c", 1)], "split string, expected long")
    g = {r.split: (r.actual, r.expected, r.ok) for r in score.row_count_gate(t, exp).collect()}
    assert g == {"a": (2, 2, True), "b": (1, None, False), "c": (0, 1, False)}


def test_repeated_predictions_are_never_scored_twice(spark):
    t = spark.createDataFrame([("a", 1, "x y"), ("a", 2, "z")], "split string, utt_id long, sentence string")
    p = spark.createDataFrame([("a", 1, 0, "x"), ("a", 1, 1, "x y"), ("a", 2, 0, None)],
                              "split string, utt_id long, attempt int, pred string")
    got = sorted(tuple(r) for r in score.join_pred_truth(t, p, order="attempt").collect())
    assert got == [("a", 1, "x y", "x y"), ("a", 2, "z", None)]
    with pytest.raises(Exception, match="repeated key: a, 1"):
        score.join_pred_truth(t, p).collect()
    with pytest.raises(Exception, match="repeated key: a, 2"):
        score.join_pred_truth(t.union(t.where("utt_id = 2")), p, order="attempt").collect()
    report = evaluate(t, p, attempt_col="attempt")
    assert report.wer.first().n_pairs == 2 and report.check.first().repeated == 1


def test_pairs_in_lockstep_equal_the_dynamic_program():
    from utterflow.functions import editdistance as E
    rnd = random.Random(3)
    for _ in range(60):
        pairs = []
        for _ in range(rnd.randrange(1, 40)):
            n, letters = rnd.choice([0, 1, 3, 20, 64, 65, 128, 200]), rnd.choice([2, 5, 100])
            a = [rnd.randrange(letters) for _ in range(rnd.randrange(n + 1))]
            b = [x for x in a if rnd.random() < 0.9] if rnd.random() < 0.5 else [rnd.randrange(letters) for _ in range(rnd.randrange(n + 1))]
            pairs.append((a, b))
        want = [reference_distance(a, b) for a, b in pairs]
        assert E.distances(pairs).tolist() == want == [edit_distance(a, b) for a, b in pairs]
        some = [p for p in (E.trimmed(a, b) for a, b in pairs) if len(p[1])]
        assert not some or E._lockstep(some).tolist() == [reference_distance(*p) for p in some]
    assert E.distances([]).tolist() == []


def test_groups_are_bounded(monkeypatch):
    """Groups of few lanes, and a table bound that every pair exceeds, change nothing."""
    from utterflow.functions import editdistance as E
    rnd = random.Random(4)
    pairs = [([rnd.randrange(9) for _ in range(rnd.randrange(1, 300))], [rnd.randrange(9) for _ in range(rnd.randrange(1, 300))]) for _ in range(80)]
    want = E.distances(pairs).tolist()
    for lanes, table in ((7, 1 << 20), (1 << 14, 1)):
        monkeypatch.setattr(E, "LANES", lanes)
        monkeypatch.setattr(E, "TABLE_BYTES", table)
        assert E.distances(pairs).tolist() == want == [edit_distance(a, b) for a, b in pairs]


def test_gate_samples_shuffle_no_pair_by_its_group(spark):
    """The samples' keys are broadcast, however few of the gate's partitions hold a row; repeated and null keys are sampled, too."""
    pairs = spark.range(2000).select(F.lit("bad").alias("split"), F.when(F.col("id") > 3, F.floor(F.col("id") / 2)).alias("utt_id"),
                                     F.col("id").cast("string").alias("ref"), F.lit("x").alias("hyp"))
    pairs = pairs.union(pairs.withColumn("split", F.lit("good")).withColumn("hyp", F.col("ref")))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        gate = pairs.groupBy("split").agg(F.when(F.max("hyp") == "x", "suspicious").otherwise("ok").alias("status"))
        df = score.gate_samples(pairs, gate)
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    ends = {end: [r.utt_id for r in sorted(got, key=lambda r: r.rank_in_end) if r.end == end] for end in ("head", "tail")}
    assert ends == {"head": [None] * 4 + [2], "tail": [999, 999, 998, 998, 997]}
    assert {r.split for r in got} == {"bad"} and len({r.reference for r in got}) == 10
    final = plan[:plan.index("== Initial Plan ==")]
    semi = [x for x in final.splitlines() if "LeftSemi" in x]
    assert semi and all("BroadcastHashJoin" in x for x in semi)


def test_bands_equal_the_dynamic_program():
    """Every band's score is the distance, or more than the band holds; bands of several words carry."""
    from utterflow.functions import editdistance as E
    rnd = random.Random(5)
    for _ in range(20):
        pairs = []
        for _ in range(20):
            n, letters = rnd.choice([1, 5, 64, 130, 300]), rnd.choice([2, 5, 100])
            a = [rnd.randrange(letters) for _ in range(rnd.randrange(1, n + 1))]
            b = [x for x in a if rnd.random() < 0.9] if rnd.random() < 0.6 else [rnd.randrange(letters) for _ in range(rnd.randrange(1, n + 1))]
            pairs.append(E.trimmed(a, b))
        pairs = sorted((p for p in pairs if len(p[1])), key=lambda p: -len(p[1]))
        want = [reference_distance(*p) for p in pairs]
        assert [E._alone(*p) for p in pairs] == want
        for margin in (0, 3, 40):
            for p, w in zip(pairs, want, strict=True):
                assert E._banded(*p, margin) == (w if w <= len(p[0]) - len(p[1]) + 2 * margin + 1 else None)
        for wide in (1, 2, 5):
            some = [(p, w) for p, w in zip(pairs, want, strict=True) if len(p[0]) - len(p[1]) < 64 * wide - 2]
            found, most = E._bands([p for p, _ in some], wide)
            for (_, w), x, y in zip(some, found, most, strict=True):
                assert x == w if w <= y else x > y


def test_words_of_a_batch_are_not_held_at_once():
    """A batch of 2 MB of text takes a few MB for its words, by pieces; one piece of it all would take some 40 MB."""
    import tracemalloc

    from utterflow.functions import editdistance as E
    rnd = random.Random(6)
    texts = [" ".join(str(rnd.randrange(10_000)) for _ in range(100)) for _ in range(4000)]
    pairs = list(zip(texts, [t[3:] for t in texts], strict=True))
    plain = E.distances((a.split(" "), b.split(" ")) for a, b in pairs[:300])
    assert E.text_distances(pairs[:300]).tolist() == plain.tolist()
    peak = []
    for chars in (200_000, 1 << 30):
        E.PIECE_CHARS, was = chars, E.PIECE_CHARS
        try:
            tracemalloc.start()
            E.text_distances(pairs)
            peak.append(tracemalloc.get_traced_memory()[1])
        finally:
            tracemalloc.stop()
            E.PIECE_CHARS = was
    assert peak[0] < peak[1] / 3
