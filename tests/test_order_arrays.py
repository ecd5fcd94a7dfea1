import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from utterflow.operators import arrays, mix, order
from utterflow.plans import catalog as C
from utterflow.plans import fixtures as fx


def test_global_position_equals_row_number(spark):
    u = fx.utt(spark, SF_SMALL).select("utt_id", "split", "source_ord", "row_ord", "shard")
    p = order.global_position(u, ["source_ord", "row_ord"], "shard")
    got = {r.utt_id: r.pos for r in p.collect()}
    rows = sorted(u.collect(), key=lambda r: (r.source_ord, r.row_ord))
    assert got == {r.utt_id: i for i, r in enumerate(rows)}
    p.collect()
    plan = p._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the per-row window is hash-partitioned by block; only the per-source
    # totals (one row per source) may meet in a single partition
    assert "hashpartitioning(source_ord" in plan
    assert plan.count("SinglePartition") <= 1


def test_global_position_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 0), (None, 2, 0), (1, 1, None), (1, 2, 0), (2, 1, 0)],
                               "source_ord int, row_ord long, shard long")
    got = sorted(((r.pos, r.source_ord, r.row_ord) for r in
                  order.global_position(df, ["source_ord", "row_ord"], "shard").collect()), key=lambda t: t[0])
    # nulls sort first (Spark's ascending default): the two null-source rows, then source 1, then 2
    assert got == [(0, None, 1), (1, None, 2), (2, 1, 1), (3, 1, 2), (4, 2, 1)]


def test_global_position_derives_range_shards(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("src"), (999 - F.col("id")).alias("row_ord"))
    p = order.global_position(df, ["src", "row_ord"], rows_per_shard=64)
    got = sorted((r.src, r.row_ord, r.pos) for r in p.collect())
    assert [g[2] for g in got] == list(range(1000))


def test_split_position_restarts(spark):
    u = fx.utt(spark, SF_SMALL).select("utt_id", "split", "source_ord", "row_ord", "shard")
    p = order.global_position(u, ["source_ord", "row_ord"], "shard", ["split"])
    for s in ("train", "validation", "test"):
        got = sorted(r.pos for r in p.where(F.col("split") == s).collect())
        assert got == list(range(len(got)))


def test_sample_budget_accumulation(spark):
    assert order.budget_rows(10, 4) == 80 and order.budget_rows(10, 16) == 160      # batch 4 -> accumulate 2
    df = spark.range(200).select(F.lit(0).alias("s"), F.col("id").alias("r"))
    for rows_per_shard in (7, 1000):
        got = order.sample_budget(df, 10, 4, ["s", "r"], rows_per_shard=rows_per_shard)
        assert sorted((r.r, r.pos) for r in got.collect()) == [(i, i) for i in range(80)]


def test_sample_budget_equals_positions(spark):
    rows = [(s, r, r // 5) for s in (2, 1, 5) for r in range(0, 60, s)]
    df = spark.createDataFrame(rows, "s int, r long, shard long").repartition(4)
    want = {(s, r): k for k, (s, r, _) in enumerate(sorted(rows))}
    for steps in (1, 3, 9, 50):
        n = order.budget_rows(steps, 8)
        got = {(r.s, r.r): r.pos for r in order.sample_budget(df, steps, 8, ["s", "r"]).collect()}
        assert got == {k: v for k, v in want.items() if v < n}


def test_sample_budget_numbers_the_kept_blocks_only(spark):
    """The join with the kept blocks stands below the window, and rows that reach it are the budget's and one block's."""
    df = spark.range(100_000).select((F.col("id") % 2).alias("s"), F.col("id").alias("r"))
    out = order.sample_budget(df, 10, 16, ["s", "r"], rows_per_shard=1000)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    top = plan[:plan.index("BroadcastHashJoin")]
    assert "Window [row_number()" in top and "_off" in top
    kept = order._join_null_safe(df.withColumn("shard", F.floor(F.col("r") / 1000)),
                                 out.select("s", F.floor(F.col("r") / 1000).alias("shard")).distinct(), ["s", "shard"])
    assert kept.count() <= 160 + 1000


def test_head_tail_overlap(spark):
    df = spark.createDataFrame([("a", i) for i in range(3)] + [("b", i) for i in range(12)], "g string, o long")
    h = order.head_tail(df, ["g"], "o", 5)
    assert h.where("g = 'a'").count() == 6
    assert sorted(r.o for r in h.where("g = 'b' and end = 'tail'").collect()) == [7, 8, 9, 10, 11]


def test_checkpoints(spark):
    m = spark.createDataFrame([(1, 50, 30), (1, 100, 20), (1, 150, 20), (1, 200, 25), (1, 250, 40)],
                              "run int, step long, wer long")
    b = order.best_checkpoint(m).first()
    assert (b.best_step, b.best_wer) == (100, 20)
    kept = sorted(r.step for r in order.retain_checkpoints(m, 3).collect())
    assert kept == [100, 200, 250]
    assert order.thin_steps(m, 100).count() == 2


def test_checkpoints_without_a_wer(spark):
    nan = float("nan")
    m = spark.createDataFrame([(1, 1, None), (1, 2, 0.7), (1, 3, 0.5), (1, 4, nan), (2, 1, None), (2, 2, nan), (3, 5, 0.25)],
                              "run int, step long, wer double")
    assert {r.run: (r.best_step, r.best_wer) for r in order.best_checkpoint(m).collect()} == {1: (3, 0.5), 2: (None, None), 3: (5, 0.25)}
    kept = {(r.run, r.step): (str(r.wer), r.is_best, r.keep_rank) for r in order.retain_checkpoints(m, 3).collect()}
    assert kept == {(1, 3): ("0.5", True, 1), (1, 4): ("nan", False, 2), (1, 2): ("0.7", False, 3),
                    (2, 2): ("nan", False, 1), (2, 1): ("None", False, 2), (3, 5): ("0.25", True, 1)}


def test_a_whole_plane_of_characters_is_no_large_plan(spark):
    import time
    chars = [chr(c) for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF and chr(c) != " "] + [chr(0x1F600), chr(0x20000)]
    vocab = {c: i for i, c in enumerate(chars, start=arrays.FIRST_CHAR_ID)}
    text = "a\ufeff, b\u0001" + chr(0xFFFF) + chr(0x1F600) + chr(0x20000) + chr(0x20001)
    df = spark.createDataFrame([(text,)], "text string")
    start = time.time()
    coded = arrays.encode_labels(df, vocab).withColumn("back", arrays.decode_labels(F.col("labels"), vocab))
    coded.select("labels", "back")._jdf.queryExecution().executedPlan()
    assert time.time() - start < 3                       # 40 s and more with a literal for every character
    row = coded.first()
    assert row.labels == [vocab.get(c, arrays.UNK_ID) if c != " " else arrays.DELIM_ID for c in text]
    assert row.back == text[:-1]


def test_pad_trim_unmask(spark):
    df = spark.createDataFrame([(0, [2, 5, 6]), (0, [2, 7, 8, 9, 10]), (1, [2, 5]), (1, [4])],
                               "batch long, labels array<int>")
    p = arrays.pad_labels(df).orderBy("batch", F.size("labels")).collect()
    b0 = [r.labels for r in p if r.batch == 0]
    assert all(len(x) == 5 for x in b0) and b0[0][-2:] == [-100, -100]
    t = {tuple(r.labels) for r in arrays.trim_bos(df).collect()}
    assert (5, 6) in t and (7, 8, 9, 10) in t and (2, 5) in t and (4,) in t
    u = df.select(arrays.unmask(F.array(F.lit(5), F.lit(-100))).alias("u")).first().u
    assert u == [5, arrays.PAD_ID]


def test_ctc_greedy_collapse_then_blank(spark):
    # classes a a _ a b b  (a=1, b=2, blank=0) -> "aab"
    cls = [1, 1, 0, 1, 2, 2]
    rows = [(7, i, [1.0 if k == c else 0.0 for k in range(4)]) for i, c in enumerate(cls)]
    df = spark.createDataFrame(rows, "utt long, frame long, scores array<float>")
    assert arrays.ctc_greedy(df, "abc").first().text == "aab"
    with pytest.raises(Exception, match="outside the alphabet"):
        arrays.ctc_greedy(df, "a").collect()


def test_frame_mask_and_rank_slices(spark):
    df = spark.createDataFrame([(0,), (160,), (161,), (479999,), (600000,)], "n long")
    got = [(len(r.m), sum(r.m)) for r in df.select(arrays.frame_mask(F.col("n")).alias("m")).collect()]
    assert got == [(3000, 0), (3000, 1), (3000, 2), (3000, 3000), (3000, 3000)]
    pos = spark.range(32).withColumnRenamed("id", "pos")
    r = {x.pos: x.rank for x in arrays.rank_slices(pos, 16, 2).collect()}
    assert all(r[i] == 0 for i in range(8)) and all(r[i] == 1 for i in range(8, 16)) and r[16] == 0
    with pytest.raises(ValueError):
        arrays.rank_slices(pos, 5, 2)


def test_encode_decode_round_trip(spark):
    u = fx.utt(spark, SF_SMALL)
    vocab = arrays.char_ids(u.where(F.col("split") == "train"), "text")
    lab = arrays.encode_labels(u, vocab, "text", "labels")
    dec = lab.select("utt_id", "split", "text", "labels", arrays.decode_labels(F.col("labels"), vocab).alias("d")).collect()
    assert all(r.d == r.text for r in dec if r.split == "train")
    assert all(len(r.labels) == len(r.text) for r in dec)


def test_encoding_does_not_depend_on_what_else_the_vocabulary_holds(spark):
    """Null, empty, emoji and full-width texts; with and without characters beyond the basic plane in the vocabulary."""
    texts = ["ab a", "", None, "a\U0001F600b", "\uFF21\uFEFFb", "\U0001F601"]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "utt_id long, text string")    # ids repeat
    plain = {"a": 4, "b": 5}
    wide = {**plain, "\U0001F600": 6, "\uFF21": 7}
    for vocab in (plain, wide):
        got = {r.text: r.labels for r in arrays.encode_labels(df, vocab).collect()}
        want = {t: [arrays.DELIM_ID if c == " " else vocab.get(c, arrays.UNK_ID) for c in t or ""] for t in texts}
        assert got == want
        counts = df.select("text", arrays.label_count(F.col("text")).alias("n")).collect()
        assert all(r.n == len(want[r.text]) for r in counts)
    frame = spark.createDataFrame(list(wide.items()), "char string, id int")
    assert arrays.encode_labels(df, frame).collect() == arrays.encode_labels(df, wide).collect()


def test_decoding_an_unknown_id_fails(spark):
    df = spark.createDataFrame([([4, 3, 5, 0, 1, 2, -100],), ([6],)], "labels array<int>")
    text = arrays.decode_labels(F.col("labels"), {"a": 4, "b": 5}).alias("t")
    assert df.limit(1).select(text).first().t == "a b"
    with pytest.raises(Exception, match="outside the vocabulary"):
        df.select(text).collect()


def test_bos_counts_only_where_it_is_put(spark, monkeypatch):
    """447 characters of a source without BOS pass F2, of a source with BOS they don't."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(3, "x" * 447, "en", "src1", 447), (4, "x" * 447, "en", "src2", 447), (5, "x" * 446, "en", "src2", 446)]
    monkeypatch.setattr(fx, "documents", lambda s, d: spark.createDataFrame(rows, schema))
    got = {r.utt_id: r.labels for r in C.QUERIES["trim_bos"](spark, SF_SMALL).collect()}
    assert set(got) == {3, 5}


def test_hot_source_positions(spark):
    """One source holds nine tenths of the rows; blocks and groups of blocks split it."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.lit(2)).otherwise(F.lit(1)).alias("src"),
                                    (F.col("id") * 7919 % 20_000).alias("row_ord"))
    got = order.global_position(df, ["src", "row_ord"], rows_per_shard=5).collect()
    assert [r.pos for r in sorted(got, key=lambda r: (r.src, r.row_ord))] == list(range(20_000))


def test_length_filters(spark):
    df = spark.createDataFrame([(0,), (1,), (479999,), (480000,)], "n long")
    assert [r.n for r in df.where(mix.audio_length_ok(F.col("n"))).collect()] == [1, 479999]
    lab = spark.createDataFrame([([],), ([1] * 447,), ([1] * 448,)], "labels array<int>")
    assert lab.where(mix.label_length_ok(F.col("labels"))).count() == 2


def test_projection_errors(spark):
    df = spark.createDataFrame([(1, "a")], "a int, sentence string")
    with pytest.raises(ValueError):
        mix.remove_columns(df, ["nope"])
    with pytest.raises(ValueError):
        mix.unify(df, 3)
    assert mix.unify(df.withColumnRenamed("a", "audio"), 2).columns == ["audio", "transcription"]
