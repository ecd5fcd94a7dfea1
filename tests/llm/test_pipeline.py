import test_line_dedup
import test_packing
import test_pii
import test_simhash

import corpus_pipeline
from utterflow.llm import pii, quality

SF = "/root/testdata/sf0.001"


def run_stages(spark, docs, sf):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf), name.replace(" ", "-"))
        out.append(docs)
    return out


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = run_stages(spark, docs, SF)
    assert [s.columns for s in stages[:-1]] == [docs.columns] * 4
    before = {r.doc_id: r for r in docs.collect()}
    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    memo = quality._Buckets()
    good = {i: r for i, r in before.items() if model.judge([model.margin(*quality.hashed(r.text or "", memo))] * quality.np.ones(1), 1.0)[1][0] >= 0.5}
    first = {r.doc_id: r for r in stages[0].collect()}
    assert first == good and 0 < len(good) < len(before)
    lines = {i: t for i, _, _, t in test_line_dedup.slow([(i, r.text) for i, r in first.items()])}
    second = {r.doc_id: r for r in stages[1].collect()}
    assert {i: r.text for i, r in second.items()} == lines and all(r.n_chars == len(r.text) for r in second.values())
    ids = list(second)
    comp = test_simhash.groups(ids, [test_simhash.slow_fingerprint(second[i].text) for i in ids])
    third = {r.doc_id: r for r in stages[2].collect()}
    assert third == {i: second[i] for i, c in zip(ids, comp) if i == c}
    terms = pii.disclosing_terms(stages[2])
    fourth = {r.doc_id: r.text for r in stages[3].collect()}
    assert fourth == {i: pii.sanitised(r.text, terms) for i, r in third.items()}
    assert not any(test_pii.slow(t) for t in fourth.values())
    rows = stages[4].collect()
    test_packing.check(rows, {i: (t, third[i].source) for i, t in fourth.items()}, 8192)


def test_run_returns_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "bin_id", "bin_offset"] and got.count() > 0


def test_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, keep string, _lines int, fp string, id int"
    rows = [(1, None, None, None, None, None, None, None, None), (None, "some words here", "en", "s", 3, "", 1, "", 1),
            (2, "some words here", "en", "s", 3, "", 1, "", 1), (3, "some words here", "en", "s", 3, "", 1, "", 1),
            (4, "z " * 100_000, "en", "s", 3, "", 1, "", 1), (5, "mail a.b@c.org now or never", "en", "s", 3, "", 1, "", 1),
            (5, "mail a.b@c.org now or never", "en", "s", 3, "", 1, "", 1), (6, "", "en", "s", 0, "", 1, "", 1)]
    stages = run_stages(spark, spark.createDataFrame(rows, schema), SF)
    if stages[0].count() == len(rows):
        assert sorted(r.doc_id or 0 for r in stages[3].collect()) == [0, 1, 2, 4, 5]
    assert "a.b@c.org" not in "".join(r.text or "" for r in stages[3].collect())
    empty = run_stages(spark, spark.createDataFrame([], schema), SF)
    assert [s.count() for s in empty] == [0] * 5


def test_every_group_keeps_one_document_when_ids_repeat(spark):
    a, b, c = ("alpha beta gamma delta " * 9, "one two three four five " * 9, "red green blue white black " * 9)
    rows = [(3, b), (7, a), (7, b), (8, c), (8, "quite another text here"), (8, c), (None, a)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(5)
        got = corpus_pipeline.simhash_near_dedup(spark, df, SF).collect()
        assert sorted((r.doc_id or 0, r.text) for r in got) == sorted(
            [(3, b), (7, a), (8, c), (8, "quite another text here"), (0, a)])
