import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import SF_SMALL
from utterflow.operators import arrays, reconcile, score
from utterflow.plans import catalog as C
from utterflow.plans import convert, evaluate, prepare
from utterflow.plans import fixtures as fx


def test_evaluate_report(spark):
    r = evaluate.evaluate(fx.truths(spark, SF_SMALL), fx.predictions(spark, SF_SMALL), attempt_col="attempt")
    wer = {x.split: x for x in r.wer.collect()}
    assert set(wer) == {"train", "validation", "test"} and all(x.status == "ok" for x in wer.values())
    assert all(not x.ok and x.pred_only == 0 for x in r.check.collect())     # German rows have no prediction
    assert {x.split for x in r.check.collect() if x.repeated} == {"train"}
    assert r.samples.count() == 0
    bad = spark.createDataFrame([("s", 1, "a b", "a b"), ("s", 2, "c", "c")], "split string, utt_id long, sentence string, pred string")
    rep = evaluate.evaluate(bad.select("split", "utt_id", "sentence"), bad.select("split", "utt_id", "pred"))
    assert rep.wer.first().status == "suspicious" and rep.samples.count() == 4


def test_training_stream(spark):
    u = fx.utt(spark, SF_SMALL).withColumnRenamed("text", "transcription")
    vocab = arrays.build_char_vocab(u.where("split = 'train'"), "transcription")
    ex = spark.createDataFrame([("src3",)], "source string")
    s = prepare.training_stream([u.where("source_ord < 10"), u.where("source_ord >= 10")], vocab, 8, 2,
                                excluded=ex, bos=True).collect()
    assert s and all(r.source != "src3" for r in s)
    by_batch = {}
    for r in s:
        by_batch.setdefault(r.batch, set()).add(len(r.labels))
        assert len(r.labels) < 448 and r.rank == (r.pos % 8) // 4
    assert all(len(v) == 1 for v in by_batch.values())            # padded to one length per batch
    assert all(r.labels[0] != arrays.BOS_ID for r in s)           # every batch started with BOS: trimmed
    assert sorted(r.pos for r in s) == list(range(len(s)))


def test_convert(spark):
    manifests = {"train": spark.createDataFrame([(json.dumps({"1": {"wav": "a.wav"}, "2": {"wav": "b.wav"}}),)], "value string"),
                 "test": spark.createDataFrame([(json.dumps({"3": {"wav": "c.wav"}}),)], "value string")}
    records = spark.createDataFrame([("a.wav", "xin - chào\n", "X0M1NY"), ("c.wav", "﻿ok ", None)],
                                    "wav string, text string, class string")
    meta, overlaps = convert.convert(manifests, records)
    rows = sorted(tuple(r) for r in meta.collect())
    assert rows == [("test", "c.wav", "ok", None, None, None, None, None),
                    ("train", "a.wav", "xin chào", "news", "male", "central dialect", "neutral", "young")]
    assert overlaps.count() == 0
    missing = spark.createDataFrame([("zz.wav", "x", None)], "wav string, text string, class string")
    with pytest.raises(Exception):
        convert.convert(manifests, missing)[0].collect()


def test_evaluate_with_a_predictor(spark):
    """U5 through the evaluation plan: predictions from a user model, then the report."""
    u = fx.utt(spark, SF_SMALL).select("split", "utt_id", "text", F.col("raw").alias("sentence"))
    pred = evaluate.predict(u, fx.make_rule_predictor, ["utt_id", "text"], batch_size=16)
    r = evaluate.evaluate(u.select("split", "utt_id", "sentence"), pred.select("split", "utt_id", "pred"))
    got = {x.split: x.edits for x in r.wer.collect()}
    want = {x.split: x.edits for x in C.QUERIES["wer_by_split"](spark, SF_SMALL).collect()}
    assert got == want
    assert all(x.ok for x in r.check.collect())


def test_evaluation_reads_its_inputs_once(spark, tmpdir_fresh):
    """WER and cardinality check come from one pass: counts are there without the inputs."""
    fx.truths(spark, SF_SMALL).write.parquet(f"{tmpdir_fresh}/t")
    fx.predictions(spark, SF_SMALL).write.parquet(f"{tmpdir_fresh}/p")
    t, p = spark.read.parquet(f"{tmpdir_fresh}/t"), spark.read.parquet(f"{tmpdir_fresh}/p")
    r = evaluate.evaluate(t, p, attempt_col="attempt")
    plans = [f._jdf.queryExecution().executedPlan().toString() for f in (r.wer, r.check)]
    assert not any(f"{tmpdir_fresh}/" in x for x in plans)
    want = {x.split: x.asDict() for x in score.pred_truth_match(t, p).collect()}
    assert {x.split: x.asDict() for x in r.check.collect()} == want
    pairs = score.join_pred_truth(t, p, order="attempt").select("split", "utt_id", F.col("sentence").alias("ref"), F.col("pred").alias("hyp"))
    assert sorted(map(tuple, r.wer.drop("status").collect())) == sorted(map(tuple, score.corpus_wer(score.word_edits(pairs), ["split"]).collect()))


def test_counts_of_the_job_that_reads(spark):
    """F9 and J7 counts as observations: no pass of their own."""
    df = spark.createDataFrame([("train", 1), ("train", 2), ("test", 3), ("odd", 4), (None, 5)], "split string, utt_id long")
    rows, seen = score.observed_counts(df, ["train", "validation", "test"])
    assert rows.count() == 5 and seen.get == {"train": 2, "validation": 0, "test": 1, "other": 2}
    members, transcripts, archives = fx.archive_members(spark, SF_SMALL), fx.split_transcripts(spark, SF_SMALL), fx.archives(spark)
    skipped = Observation("skipped")
    got = reconcile.shard_transcripts(members, transcripts, archives, seen=skipped)
    want = reconcile.shard_transcripts(members, transcripts, archives)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    counts = reconcile.shard_counts(members, transcripts, archives).agg(F.sum("n_matched"), F.sum("n_unmatched")).first()
    assert (skipped.get["n_rows"], skipped.get["n_skipped"]) == tuple(counts)
