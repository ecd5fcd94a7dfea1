from pyspark.sql import functions as F

from utterflow.operators import mix, reconcile
from utterflow.sources import readers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_assign_split_priority(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "path string")
    lists = spark.createDataFrame([("test", "a"), ("train", "a"), ("validation", "b"), ("test", "b"), ("test", "c"),
                                   ("test", "c")], "split string, path string")
    assert rows(reconcile.assign_split(ids, lists)) == [("a", "train"), ("b", "validation"), ("c", "test"), ("d", "")]


def test_split_overlaps_pairs(spark):
    lists = spark.createDataFrame([("train", "a"), ("test", "a"), ("validation", "a"), ("train", "b"),
                                   ("validation", "b"), ("test", "c")], "split string, path string")
    got = rows(reconcile.split_overlaps(lists))
    assert got == [("test", "train", 1), ("test", "validation", 1), ("train", "validation", 2)]


def test_orphans_and_union_splits(spark):
    files = spark.createDataFrame([("x.wav",), ("y.wav",)], "path string")
    tr = spark.createDataFrame([("x.wav",)], "path string")
    assert rows(reconcile.orphans(files, tr)) == [("orphan", "y.wav", " ")]
    a = spark.createDataFrame([(1, "s")], "id int, speaker string")
    b = spark.createDataFrame([(2, "o")], "id int, age string")
    u = reconcile.union_splits([("train", a), ("test", b)])
    assert sorted(u.columns) == ["age", "id", "speaker", "split"]
    assert rows(u.select("id", "split", "speaker", "age")) == [(1, "train", "s", None), (2, "test", None, "o")]


def test_strict_lookup_reports_missing(spark):
    rec = spark.createDataFrame([("a.wav",), ("z.wav",)], "wav string")
    lk = spark.createDataFrame([("a.wav", "data/train/a.wav")], "wav string, file_name string")
    assert rows(reconcile.strict_lookup(rec, lk, "wav", "file_name")) == [("a.wav", "data/train/a.wav"), ("z.wav", None)]


def test_strict_lookup_never_fans_out(spark):
    rec = spark.createDataFrame([("a.wav",), ("b.wav",)], "wav string")
    lk = spark.createDataFrame([("a.wav", "train/a", 0), ("a.wav", "test/a", 2), ("a.wav", "val/a", 1), ("b.wav", "train/b", 0)],
                               "wav string, file_name string, list int")
    assert rows(reconcile.strict_lookup(rec, lk, "wav", "file_name", order="list")) == [("a.wav", "test/a"), ("b.wav", "train/b")]
    try:
        reconcile.strict_lookup(rec, lk, "wav", "file_name").collect()
        raise AssertionError("a repeated key without an order must fail")
    except Exception as e:
        assert "listed twice" in str(e)


def test_row_count_gate_unexpected_split(spark):
    from utterflow.operators import score
    df = spark.createDataFrame([("train",), ("odd",)], "split string")
    expected = spark.createDataFrame([("train", 1), ("dev", 2)], "split string, expected long")
    assert {r.split: (r.actual, r.expected, r.ok) for r in score.row_count_gate(df, expected).collect()} == {
        "train": (1, 1, True), "odd": (1, None, False), "dev": (0, 2, False)}


def test_corpus_mix_tells_null_source_from_total(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "source string")
    got = sorted((r.source or "", r.n_rows, r.is_total) for r in mix.corpus_mix(df).collect())
    assert got == [("", 2, False), ("", 3, True), ("a", 1, False)]


def test_corpus_mix_and_exclusions(spark):
    df = spark.createDataFrame([("s1",), ("s1",), ("s2",), ("s3",)], "source string")
    got = {r.source: (r.n_rows, r.is_total) for r in mix.corpus_mix(df).collect()}
    assert got == {"s1": (2, False), "s2": (1, False), "s3": (1, False), None: (4, True)}
    ex = spark.createDataFrame([("s3",)], "source string")
    assert mix.exclude_sources(df, ex).count() == 3
    assert mix.mix_optional([df], [df], include=False).count() == 4
    assert mix.mix_optional([df], [df], include=True).count() == 8


def test_cast_audio_rounds_half_up(spark):
    df = spark.createDataFrame([("a", 3, 32000), ("b", 441, 44100), ("c", 1, 48000), ("d", 480000, 16000)],
                               "path string, n_samples long, sampling_rate int")
    a = df.select(F.struct("path", "n_samples", "sampling_rate").alias("audio"))
    got = [r.audio.n_samples_resampled for r in mix.cast_audio(a).collect()]
    assert got == [2, 160, 0, 480000]          # 1.5 -> 2, 160 exact, 0.33 -> 0


def test_jsonl_basename_and_unify(spark):
    df = spark.createDataFrame([('{"key": "wavs/a/b.wav", "text": "xin chào", "extra": 1}',)], "value string")
    assert rows(readers.parse_jsonl_manifest(df)) == [("b.wav", "xin chào")]
    c = spark.createDataFrame([(1, "x", "y")], "audio int, transcription string, other string")
    assert mix.unify(c, 1).columns == ["audio", "transcription"]
    assert mix.unify(c, 0).columns == ["audio", "transcription", "other"]


def test_corpus_registry_pushes_config_filter(spark):
    from conftest import SF_SMALL
    reg = readers.CorpusRegistry().register("docs", f"{SF_SMALL}/documents.parquet", "lang")
    df = reg.load(spark, "docs", config="fr", columns=["doc_id", "lang"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,fr)" in plan and {r.lang for r in df.collect()} == {"fr"}
    try:
        readers.CorpusRegistry().register("x", f"{SF_SMALL}/documents.parquet").load(spark, "x", config="fr")
        raise AssertionError("expected an error for a corpus without a config column")
    except ValueError:
        pass


def test_from_columns(spark):
    df = readers.from_columns(spark, {"source": ["a", "b"], "n": [1, 2]}, "source string, n int")
    assert rows(df) == [("a", 1), ("b", 2)]
