"""Plan-shape checks: pushdown, pruning, broadcast of literal lookups, no Python on the native path."""

import pytest

from conftest import SF_SMALL
from utterflow.operators import reconcile, score
from utterflow.plans import catalog as C
from utterflow.plans import fixtures as fx


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_language_filter_pushed_and_pruned(spark):
    p = plan(C.QUERIES["filter_language"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in p
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string,n_chars:bigint>" in p


def final_plan(df):
    df.collect()                 # runs df's own query execution, so AQE records its final plan
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_exclusion_is_broadcast_after_measuring(spark):
    p = final_plan(C.QUERIES["filter_excluded_sources"](spark, SF_SMALL))
    assert "isFinalPlan=true" in p and "BroadcastHashJoin" in p and "LeftAnti" in p


def test_native_scoring_stays_in_jvm(spark):
    p = plan(score.word_edits(fx.pairs(spark, SF_SMALL), method="native"))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p
    assert p.count("Exchange") == 1      # the spread of documents only; window/regroup reuse it


def test_wer_by_split_single_data_exchange(spark):
    p = plan(C.QUERIES["wer_by_split"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning(doc_id") == 1
    assert "partial_sum" in p


def test_head_tail_uses_group_limit(spark):
    df = C.QUERIES["head_tail_sample"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString() or \
        "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_small_lookups_become_broadcast_at_run_time(spark):
    """No hand-written hint; AQE measures the lookup side and broadcasts it."""
    for key in ("join_split_assign", "join_strict_lookup", "join_shard_transcripts"):
        p = final_plan(C.QUERIES[key](spark, SF_SMALL))
        assert "BroadcastHashJoin" in p, key


def test_positions_shuffle_rows_once(spark):
    """Rows cross one block exchange; block counts travel as partial aggregates. No text is read."""
    full = final_plan(C.QUERIES["global_position"](spark, SF_SMALL))
    p = full.splitlines()
    row_level = 0
    for i, line in enumerate(p):
        if "Exchange hashpartitioning(source_ord" in line and "block" in line and "ReusedExchange" not in line:
            child = next(x for x in p[i + 1:] if "AQEShuffleRead" not in x and "ShuffleQueryStage" not in x)
            if "partial_count" not in child:
                row_level += 1
    assert row_level == 1 and "text" not in full and "doc_id, 16" not in full


def test_training_batches_scan_and_encode_text_once(spark, monkeypatch):
    """Encoding and F2 run in one job over one scan; positions read the written rows, all scans but one without labels."""
    plans = []
    real = C.sinks.materialize
    monkeypatch.setattr(C.sinks, "materialize", lambda df, *a: (plans.append(plan(df)), real(df, *a))[1])
    after = final_plan(C.QUERIES["pad_labels"](spark, SF_SMALL))
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and plans[0].count("split(") == 1
    assert "documents.parquet" not in after and "split(" not in after
    scans = [x for x in after.splitlines() if "FileScan" in x]
    assert sum("labels:array" in x for x in scans) == 1


def test_vocabulary_is_built_once(spark, monkeypatch):
    calls = []
    real = C.arrays.ids_of
    monkeypatch.setattr(C.arrays, "ids_of", lambda v: (calls.append(1), real(v))[1])
    for key in ("decode_labels", "wer_from_ids"):
        calls.clear()
        C.QUERIES[key](spark, SF_SMALL)
        assert len(calls) == 1, key


def test_hot_lookup_keys_can_be_split(spark):
    """A third of the records share one key: the aggregated lookup has its own exchange, so the skew join splits them."""
    from pyspark.sql import functions as F

    from utterflow.operators import reconcile
    rec = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("wav"), F.col("id"))
    lookup = spark.range(60_000).select(F.col("id").cast("string").alias("wav"), F.lit("f").alias("file_name")).union(
        spark.createDataFrame([("hot", "h")], "wav string, file_name string"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = reconcile.strict_lookup(rec, lookup, "wav", "file_name")
        p = final_plan(df)
        assert df.where("file_name = 'h'").count() == 20_000 and "skew=true" in p
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stored_manifests_are_reconciled_without_an_exchange(spark, tmp_path):
    """J2-J5 and J8 read buckets side by side; results are those of plain frames, also for a later session."""
    from utterflow.sources.manifests import ManifestStore
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = C._manifest_store(spark, SF_SMALL, buckets=4)
        later = ManifestStore(spark, store.root, 4)
        for s in (store, later):
            files, listed, lists = (s.get(n) for n in ("files", "listed", "lists"))
            plain = fx.files(spark, SF_SMALL), fx.listed(spark, SF_SMALL), fx.split_lists(spark, SF_SMALL)
            for got, want, exchanges in (
                    (reconcile.listed_existing(listed, files), reconcile.listed_existing(plain[1], plain[0]), 0),
                    (reconcile.complement(files, listed), reconcile.complement(plain[0], plain[1]), 0),
                    (reconcile.assign_split(files, lists, bucketed=True), reconcile.assign_split(plain[0], plain[2]), 0),
                    (reconcile.orphans(files, listed), reconcile.orphans(plain[0], plain[1]), 0),
                    (reconcile.split_overlaps(lists), reconcile.split_overlaps(plain[2]), 1)):     # one: counts per pair of splits
                assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
                p = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
                assert p.count("Exchange") - p.count("ReusedExchange") == exchanges, p
                assert exchanges == 0 or "Exchange hashpartitioning(path" not in p
        with pytest.raises(ValueError, match="4 buckets"):
            ManifestStore(spark, store.root, 8).get("files")
        old = store.get("files")
        n = old.count()
        store.put("files", old.limit(3))
        assert store.get("files").count() == 3 and old.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
