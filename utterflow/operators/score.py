"""Word error rate: per-pair edit distance, corpus WER, gates.

The normalizer is a chain of built-in regex/trim expressions (JVM, code
generated). The word-level edit distance is either a bit-parallel dynamic
program in an Arrow-batched pandas UDF (default) or, all in the JVM, Spark's
``levenshtein`` over strings carrying one character per word. Corpus WER is
an integer sum/sum ratio with partial + final hash aggregation, so only one
small row per (map task, split) crosses the shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.editdistance import word_edit_distance
from ..functions.text import ids_to_string, normalize_words
from .order import head_tail


# Session setting choosing the edit-distance implementation: bitparallel | native.
METHOD_CONF = "spark.utterflow.editDistance"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread rows over the cluster before quadratic per-row work.

    Source files may hold few large row groups; the edit distance costs
    O(n*m) per pair, so a deterministic hash repartition on the pair key (safe
    to recompute after executor loss) gives every core a share. An explicit
    partition count keeps AQE from coalescing the cheap-looking text back.
    """
    return df.repartition(shuffle_partitions(df.sparkSession), F.col(key))


def word_edits(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp",
               keys: Sequence[str] = ("split", "utt_id"), spread_key: str | None = None,
               pair_key: str = "utt_id", method: str | None = None) -> DataFrame:
    """A1: keys + ref_words, hyp_words, edits (substitutions + deletions + insertions).

    Both sides are normalized (X16). An empty (or null) reference counts
    every hypothesis word as an insertion. ``pair_key`` identifies a pair; pass
    ``spread_key`` when the input is not yet hash-partitioned on it.

    The method defaults to the session setting spark.utterflow.editDistance.
    method="bitparallel": words go to an Arrow-batched pandas UDF running the
      bit-vector edit distance (O(n*m/64) per pair; two to three times faster
    method="native": everything in the JVM: per-pair dense word ids (window
      over exploded words), one character per id, built-in ``levenshtein``.
    """
    method = method or pairs.sparkSession.conf.get(METHOD_CONF, "bitparallel")
    base = pairs.select(*keys, F.col(ref).alias("_ref"), F.col(hyp).alias("_hyp"))
    if spread_key:
        base = spread(base, spread_key)
    empty = F.array().cast("array<string>")          # a null transcript scores as an empty one
    words = base.select(*keys, F.coalesce(normalize_words("_ref"), empty).alias("_rw"),
                        F.coalesce(normalize_words("_hyp"), empty).alias("_hw"))
    if method == "bitparallel":
        n, m, r, h = F.size("_rw"), F.size("_hw"), F.array_join("_rw", " "), F.array_join("_hw", " ")
        joined = words.select(*keys, n.alias("_n"), m.alias("_m"), r.alias("_r"), h.alias("_h"))
        return joined.select(*keys, F.col("_n").cast("bigint").alias("ref_words"), F.col("_m").cast("bigint").alias("hyp_words"),
                             word_edit_distance(*map(F.col, ("_r", "_h", "_n", "_m"))).alias("edits"))
    if method != "native":
        raise ValueError(f"unknown method {method!r}")
    ids = encode_pair_words(words, list(keys), "_rw", "_hw", pair_key=pair_key)
    enc = ids.select(*keys, F.size("_ri").cast("bigint").alias("ref_words"),
                     F.size("_hi").cast("bigint").alias("hyp_words"),
                     ids_to_string(F.col("_ri")).alias("_re"), ids_to_string(F.col("_hi")).alias("_he"))
    return enc.select(*keys, "ref_words", "hyp_words",
                      F.levenshtein("_re", "_he").cast("bigint").alias("edits"))


def encode_pair_words(words: DataFrame, keys: list[str], ref: str, hyp: str, pair_key: str) -> DataFrame:
    """Number the distinct words of every pair 1..d (dense rank in word order).

    Words of both sides are exploded with (side, position), ranked by a window
    partitioned by the pair key, and gathered back in position order. When
    the input is already hash-partitioned on ``pair_key`` (see ``spread``) the
    window and the regrouping reuse that partitioning: no extra shuffle, one
    sort of (pair, word) per task, and every group is one transcript pair.
    Returns keys + _ri, _hi (int arrays).
    """
    # (side, position, id) packed into one bigint: side << 62 | position << 31 | id,
    # so restoring position order is a primitive sort, not a struct sort.
    tagged = F.concat(
        F.transform(F.col(ref), lambda w, i: F.struct(i.cast("bigint").alias("p"), w.alias("w"))),
        F.transform(F.col(hyp), lambda w, i: F.struct((i.cast("bigint") + F.lit(1 << 31)).alias("p"),
                                                     w.alias("w"))))
    toks = words.select(*keys, F.inline_outer(tagged))
    rank = F.dense_rank().over(Window.partitionBy(pair_key).orderBy("w"))
    packed = F.when(F.col("w").isNotNull(), F.shiftleft(F.col("p"), 31) + rank)
    back = (toks.withColumn("_k", packed).groupBy(*keys)
            .agg(F.sort_array(F.collect_list("_k")).alias("_t")))
    low = F.lit((1 << 31) - 1)
    ref_ids = F.transform(F.filter("_t", lambda x: x < F.lit(1 << 62)), lambda x: (x.bitwiseAND(low)).cast("int"))
    hyp_ids = F.transform(F.filter("_t", lambda x: x >= F.lit(1 << 62)), lambda x: (x.bitwiseAND(low)).cast("int"))
    return back.select(*keys, ref_ids.alias("_ri"), hyp_ids.alias("_hi"))


def wer_ratio(edits: Column, words: Column) -> Column:
    """100 * edits / words as a double; null when there are no reference words."""
    return F.try_divide(edits * F.lit(100), words)


def corpus_wer(edits: DataFrame, group_cols: Sequence[str] = (), pairs: str | None = None,
               more: Sequence[Column] = ()) -> DataFrame:
    """A2/A3: micro-averaged WER = 100 * sum(edits) / sum(reference words).

    Of rows for which the column ``pairs`` holds, if given; ``more`` are further
    aggregates over all rows.
    """
    def of(c: Column) -> Column:
        return F.when(F.col(pairs), c) if pairs else c

    agg = [F.count(of(F.lit(1))).alias("n_pairs"),
           F.sum(of(F.col("edits"))).alias("edits"),
           F.sum(of(F.col("ref_words"))).alias("ref_words"),
           F.sum(of(F.when(F.col("ref_words") == 0, 1).otherwise(0))).cast("bigint").alias("n_empty_ref"), *more]
    g = edits.groupBy(*group_cols).agg(*agg) if group_cols else edits.agg(*agg)
    return g.withColumn("wer", wer_ratio(F.col("edits"), F.col("ref_words")))


def wer_gate(wer: DataFrame, wer_col: str = "wer") -> DataFrame:
    """0 < wer < 100 is ok; anything else (including exactly 0) is suspicious."""
    ok = (F.col(wer_col) > 0) & (F.col(wer_col) < 100)
    return wer.withColumn("status", F.when(ok, F.lit("ok")).otherwise(F.lit("suspicious")))


def gate_samples(pairs: DataFrame, gate: DataFrame, k: int = 5, group_col: str = "split", order_col: str = "utt_id") -> DataFrame:
    """first and last ``k`` (reference, prediction) pairs of every suspicious group.

    Groups are few. What is sampled is found on the narrow columns, where every task keeps k rows per group and
    end (see ``order.head_tail``); these keys are broadcast, so no pair that is not sampled is shuffled or read by
    the task of its group. Rows that share a sampled key are ranked again with their texts.
    """
    bad = gate.where(F.col("status") != "ok").select(F.col(group_col).alias("_g"))
    ends = head_tail(pairs.select(group_col, order_col), [group_col], order_col, k)
    keys = ends.join(bad, F.col(group_col) == F.col("_g")).select("_g", F.col(order_col).alias("_o"))
    sampled = (pairs[group_col] == keys["_g"]) & pairs[order_col].eqNullSafe(keys["_o"])
    return head_tail(pairs.join(F.broadcast(keys), sampled, "left_semi"), [group_col], order_col, k).select(
        group_col, "end", "rank_in_end", order_col, F.col("ref").alias("reference"), F.col("hyp").alias("prediction"))


def one_per_key(df: DataFrame, keys: Sequence[str], order: str | None = None, count: str = "_n") -> DataFrame:
    """One row per key, the one with the largest ``order``, and the key's number of rows; without an order a
    repeated key is an error.

    A partial aggregate, on the partitioning that a join on the keys uses.
    """
    rest = F.struct(*[c for c in df.columns if c not in keys])
    n = F.count(F.lit(1)).alias(count)
    if order is not None:
        one = df.groupBy(*keys).agg(F.max_by(rest, order).alias("_row"), n)
    else:
        named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        one = df.groupBy(*keys).agg(F.first(rest).alias("_row"), n).withColumn(
            "_row", F.when(F.col(count) > 1, F.raise_error(F.concat(F.lit("repeated key: "), named))).otherwise(F.col("_row")))
    return one.select(*keys, "_row.*", count)


def align(truth: DataFrame, pred: DataFrame, keys: Sequence[str] = ("split", "utt_id"),
          order: str | None = None) -> DataFrame:
    """J11 with what it leaves out: truths and predictions by key, ``_t`` and ``_p`` rows of a key on either side."""
    k = list(keys)
    mine = one_per_key(pred, k, order, "_p")
    j = one_per_key(truth, k, count="_t").join(mine.drop(order) if order else mine, on=k, how="full_outer")
    return j.fillna(0, ["_t", "_p"])


def join_pred_truth(truth: DataFrame, pred: DataFrame, keys: Sequence[str] = ("split", "utt_id"),
                    order: str | None = None) -> DataFrame:
    """Align predictions with truths by key, never by position.

    Of several predictions of a key the one with the largest ``order`` (e.g. the
    attempt) counts; without an order, and for truths always, a repeated key is
    an error, so no truth is scored twice.
    """
    return align(truth, pred, keys, order).where("_t > 0 and _p > 0").drop("_t", "_p")


def match_counts() -> list[Column]:
    """F10 over rows of ``align`` (or counts ``_t`` and ``_p`` per key)."""
    def n(condition: Column) -> Column:
        return F.sum(condition.cast("bigint"))

    t, p = F.col("_t"), F.col("_p")
    return [n(p == 0).alias("truth_only"), n(t == 0).alias("pred_only"), n((t > 0) & (p > 0)).alias("matched"),
            F.sum(F.greatest(t - 1, F.lit(0)) + F.greatest(p - 1, F.lit(0))).alias("repeated")]


def _match_ok() -> Column:
    return (F.col("truth_only") == 0) & (F.col("pred_only") == 0) & (F.col("repeated") == 0)


def pred_truth_match(truth: DataFrame, pred: DataFrame, keys: Sequence[str] = ("split", "utt_id"),
                     group_col: str = "split") -> DataFrame:
    """per split, keys only in truth, only in predictions, and in both, and rows that repeat a key.

    ``ok`` only if none is one-sided or repeated. Rows are counted per key, by
    partial aggregates, before the two sides meet.
    """
    k = list(keys)
    t = truth.groupBy(*k).agg(F.count(F.lit(1)).alias("_t"))
    p = pred.groupBy(*k).agg(F.count(F.lit(1)).alias("_p"))
    j = t.join(p, on=k, how="full_outer").fillna(0, ["_t", "_p"])
    return j.groupBy(group_col).agg(*match_counts()).withColumn("ok", _match_ok())


def evaluated(truth: DataFrame, pred: DataFrame, truth_col: str, pred_col: str, keys: Sequence[str] = ("split", "utt_id"),
              order: str | None = None) -> DataFrame:
    """A3 and F10 in one pass, one row per split: truths and predictions are read, joined and normalized once."""
    k = list(keys)
    both = F.col("_t") * F.col("_p") > 0
    rows = align(truth, pred, k, order).select(*k, "_t", "_p", F.when(both, F.col(truth_col)).alias("ref"),
                                               F.when(both, F.col(pred_col)).alias("hyp"))
    edits = word_edits(rows, keys=[*k, "_t", "_p"], pair_key=k[-1])
    out = corpus_wer(edits.withColumn("_pair", both), [k[0]], "_pair", match_counts())
    return out.withColumn("ok", _match_ok())


def observed_counts(df: DataFrame, splits: Sequence[str], group_col: str = "split") -> tuple[DataFrame, Observation]:
    """F9 without a pass of its own: ``df``, and an observation that has the rows of each of ``splits`` and of
    all others (``other``) when the job that ``df`` is part of has ended."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    known = F.col(group_col).isin(*splits)
    counts = [F.count_if(F.col(group_col) == s).alias(s) for s in splits]
    return df.observe(seen, *counts, F.count_if(known.isNull() | ~known).alias("other")), seen


def row_count_gate(df: DataFrame, expected: DataFrame, group_col: str = "split") -> DataFrame:
    """actual vs expected rows per split (full outer: missing splits show, unexpected ones are not ok)."""
    actual = df.groupBy(group_col).agg(F.count(F.lit(1)).alias("actual"))
    j = actual.join(expected, on=group_col, how="full_outer")
    return j.select(group_col, F.coalesce("actual", F.lit(0)).cast("bigint").alias("actual"),
                    F.col("expected").cast("bigint").alias("expected"),
                    F.coalesce("actual", F.lit(0)).eqNullSafe(F.col("expected")).alias("ok"))
