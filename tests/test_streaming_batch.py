from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from utterflow.operators import batch
from utterflow.plans import catalog as C
from utterflow.plans import fixtures as fx
from utterflow.streaming import stream


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_stream_wer_equals_batch(spark):
    assert _sorted(C.QUERIES["stream_wer"](spark, SF_SMALL)) == _sorted(C.QUERIES["wer_by_split"](spark, SF_SMALL))


def test_stream_prepare_equals_batch(spark):
    s = C.QUERIES["stream_prepare"](spark, SF_SMALL)
    audio_ok = {r.utt_id for r in C.QUERIES["filter_audio_length"](spark, SF_SMALL).collect()}
    labels_ok = {r.utt_id: r.label_length for r in C.QUERIES["filter_label_length"](spark, SF_SMALL).collect()}
    expected = sorted((k, v) for k, v in labels_ok.items() if k in audio_ok)
    assert sorted((r.utt_id, r.label_length) for r in s.collect()) == expected


def test_score_batches_equals_row_at_a_time(spark):
    u = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 13))) for i in range(60)], "utt_id long, text string")
    a = u.select("utt_id", batch.score_batches(fx.make_rule_predictor, ["utt_id", "text"], T.StringType(), 16).alias("p"))
    b = u.select("utt_id", batch.score_batches(fx.make_rule_predictor, ["utt_id", "text"], T.StringType(), 1).alias("p"))
    assert _sorted(a) == _sorted(b)


def test_map_batches_batch_size(spark):
    df = spark.range(100).repartition(1)
    out = batch.map_batches(df, lambda pdf: pdf.assign(n=len(pdf)), "id long, n long", batch_size=30)
    sizes = sorted(r.n for r in out.collect())
    assert sizes.count(30) == 90 and sizes.count(10) == 10
    assert sorted(r.id for r in out.collect()) == list(range(100))


def test_running_wer_over_two_batches_and_a_restart(spark, tmpdir_fresh):
    """Files arrive in two batches, then one more after a restart from the checkpoint."""
    src, out, cp = (f"{tmpdir_fresh}/{n}" for n in ("in", "out", "cp"))
    rows = [("s" if i % 3 else "t", i, "a b c d", "a x c" if i % 2 else "a b c d e") for i in range(12)]
    schema = "split string, utt_id long, ref string, hyp string"
    width = spark.conf.get("spark.sql.shuffle.partitions")

    def arrive(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        own = stream.stream_session(spark)
        return _sorted(stream.running_wer(own.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), out, cp))

    def batch_result(part):
        from utterflow.operators import score
        return _sorted(score.corpus_wer(score.word_edits(spark.createDataFrame(part, schema)), ["split"]))

    arrive(rows[:5])
    arrive(rows[5:8])
    assert run() == batch_result(rows[:8])
    arrive(rows[8:])
    assert run() == batch_result(rows)
    assert spark.conf.get("spark.sql.shuffle.partitions") == width


def test_stream_positions_equal_batch(spark):
    got = C.QUERIES["stream_position"](spark, SF_SMALL)
    assert _sorted(got.select("utt_id", "split", "pos")) == _sorted(C.QUERIES["split_position"](spark, SF_SMALL))


def test_positions_go_on_over_batches_restarts_and_retries(spark, tmpdir_fresh):
    import glob
    import os
    src, out, cp = (f"{tmpdir_fresh}/{n}" for n in ("in", "out", "cp"))
    schema = "split string, s int, r long"
    arrived = []

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        arrived.append(rows)

    def run():
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        return stream.numbered_stream(rows, out, cp, ["s", "r"], rows_per_shard=3, batch_size=4)

    def want():
        nxt, expected = {}, []
        for rows in arrived:
            for split, s, r in sorted(rows, key=lambda x: x[1:]):
                pos = nxt.get(split, 0)
                nxt[split] = pos + 1
                expected.append((split, s, r, pos, pos // 4, pos % 4))
        return sorted(expected, key=str)

    def rows(df):
        return sorted((tuple(r) for r in df.select("split", "s", "r", "pos", "batch", "slot").collect()), key=str)

    arrive([("a" if i % 3 else None, i % 2, 100 - i) for i in range(20)])
    arrive([("b" if i % 2 else "a", 0, i) for i in range(7)])
    assert rows(run()) == want()
    arrive([("a", 1, i) for i in range(5)] + [("new", 0, 0)])
    assert rows(run()) == want()                                  # after a restart
    assert rows(run()) == want()                                  # nothing new
    last = max(glob.glob(f"{cp}/commits/[0-9]*"), key=lambda f: int(os.path.basename(f)))
    os.replace(last, f"{tmpdir_fresh}/moved")                     # as if the last micro-batch had failed after its writing
    for crc in glob.glob(f"{cp}/commits/.*.crc"):
        os.replace(crc, f"{tmpdir_fresh}/moved-{os.path.basename(crc)}")
    assert rows(run()) == want()
    arrive([("b", 0, 9), ("a", 0, 9)])
    assert rows(run()) == want()


def test_wide_streams_do_not_shuffle_text(spark, monkeypatch, tmpdir_fresh):
    """A stream is spread only where its files yield fewer splits than there are cores."""
    seen = []
    real_wer, real_prepare = stream.running_wer, stream.prepare_stream
    monkeypatch.setattr(stream, "running_wer", lambda p, *a: (seen.append(p), real_wer(p, *a))[1])
    monkeypatch.setattr(stream, "prepare_stream", lambda p, *a: (seen.append(p), real_prepare(p, *a))[1])
    files = 4 * spark.sparkContext.defaultParallelism
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(files).write.parquet(f"{tmpdir_fresh}/documents.parquet")
    for key in ("stream_wer", "stream_prepare"):
        assert _sorted(C.QUERIES[key](spark, tmpdir_fresh)) == _sorted(C.QUERIES[key](spark, SF_SMALL))
    shuffled = ["Repartition" in df._jdf.queryExecution().logical().toString() for df in seen]
    assert shuffled == [False, True, False, True]
