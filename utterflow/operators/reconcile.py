"""Manifest vs file reconciliation.

All joins are equi-joins. Lookups whose size is not bounded by construction
carry no broadcast hint: AQE measures the materialized side at run time and
broadcasts it only when it is below the threshold, else keeps a shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.paths import stem
from ..functions.text import clean_transcript

# Fixed values that must equal the reference's behaviour.
SPLIT_PRIORITY = ("train", "validation", "test")   # first match wins; none -> ""
ORPHAN_SPLIT = "orphan"
ORPHAN_TEXT = " "                                   # never "", see SURVEY 1.2


def join_reduced(rows: DataFrame, reduced: DataFrame, key: str) -> DataFrame:
    """Left join with a lookup that was just aggregated by ``key``.

    Such an aggregate is partitioned by its key already, and then AQE cannot
    split the rows of a hot key; a second key that follows from the first gives
    the lookup an exchange of its own, and the skew join works.
    """
    part = F.pmod(F.hash(key), F.lit(1 << 16))
    return rows.withColumn("_part", part).join(reduced.withColumn("_part", part), [key, "_part"], "left").drop("_part")


def sidecar_diff(audio: DataFrame, texts: DataFrame, key: str = "stem") -> DataFrame:
    """(kind, stem) for audio without a sidecar text and text without audio."""
    a = audio.select(key).distinct()
    t = texts.select(key).distinct()
    no_text = a.join(t, key, "left_anti").select(F.lit("audio_without_text").alias("kind"), key)
    no_audio = t.join(a, key, "left_anti").select(F.lit("text_without_audio").alias("kind"), key)
    return no_text.unionByName(no_audio)


def split_overlaps(lists: DataFrame, key: str = "path", split: str = "split") -> DataFrame:
    """Leakage check. For every pair of splits, how many keys both contain.

    One shuffle: group by key, keep keys in >= 2 splits (each group holds at
    most the number of splits), emit their split pairs, count per pair.
    """
    per_key = lists.groupBy(key).agg(F.array_sort(F.collect_set(split)).alias("_s"))
    multi = per_key.where(F.size("_s") > 1)
    pairs = multi.select(F.explode(F.filter(
        F.flatten(F.transform("_s", lambda a: F.transform("_s", lambda b: F.array(a, b)))),
        lambda p: p[0] < p[1])).alias("_p"))
    return (pairs.groupBy(F.col("_p")[0].alias("split_a"), F.col("_p")[1].alias("split_b"))
            .agg(F.count(F.lit(1)).alias("n_shared")))


def listed_existing(listed: DataFrame, existing: DataFrame, key: str = "path") -> DataFrame:
    """Listed entries that exist (left semi), distinct."""
    return listed.select(key).join(existing.select(key), key, "left_semi").distinct()


def complement(all_files: DataFrame, subset: DataFrame, key: str = "path") -> DataFrame:
    """Files not in ``subset`` (left anti)."""
    return all_files.select(key).join(subset.select(key), key, "left_anti")


def assign_split(ids: DataFrame, lists: DataFrame, key: str = "path", split: str = "split",
                 priority: Sequence[str] = SPLIT_PRIORITY, bucketed: bool = False) -> DataFrame:
    """Split by membership, first in ``priority`` wins; unassigned -> "".

    Membership lists are reduced to one (key, best rank) row per key with a
    partial aggregate before the join, so duplicated keys never fan out. With
    ``bucketed`` both sides are stored by the key (see ``sources.manifests``) and
    are joined where they lie.
    """
    rank = F.lit(len(priority))
    for i, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col(split) == name, F.lit(i)).otherwise(rank)
    best = lists.groupBy(key).agg(F.min(rank).alias("_r"))
    names = F.array(*[F.lit(p) for p in priority])
    j = ids.join(best, key, "left") if bucketed else join_reduced(ids, best, key)
    return j.withColumn("assigned", F.coalesce(F.get(names, F.col("_r")), F.lit(""))).drop("_r")


def strict_lookup(records: DataFrame, lookup: DataFrame, key: str, value: str,
                  strict: bool = False, order: str | None = None) -> DataFrame:
    """Look every record's key up; a miss fails the job when ``strict``.

    A key that is listed several times takes the value with the largest
    ``order`` (merged lists: the last one wins); without an order a repeated
    key is an error. Either way the lookup is one row per key before the join,
    by partial aggregation, so records never fan out. Non-strict mode keeps
    the row with a null value so misses can be counted.
    """
    if order is not None:
        one = lookup.groupBy(key).agg(F.max_by(value, order).alias(value))
    else:
        one = lookup.groupBy(key).agg(F.min(value).alias(value), F.count(F.lit(1)).alias("_n")).select(
            key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("key listed twice: "), F.col(key).cast("string"))))
            .otherwise(F.col(value)).alias(value))
    j = join_reduced(records, one, key)
    if strict:
        j = j.withColumn(value, F.when(F.col(value).isNull(),
                                       F.raise_error(F.concat(F.lit("missing key: "), F.col(key).cast("string"))))
                         .otherwise(F.col(value)))
    return j


def shard_transcripts(members: DataFrame, transcripts: DataFrame, archives: DataFrame, member_path: str = "path",
                      archive: str = "archive", key: str = "key", seen: Observation | None = None) -> DataFrame:
    """Every split's archive members joined to that split's transcripts by stem.

    ``members`` has (archive, path), ``archives`` (split, archive) says which
    archives a split reads, ``transcripts`` has (split, key, transcription). An
    id of one split found in another split's archive does not match. Members
    without a transcript are left out; with ``seen`` the join that skips them
    counts them, too: the observation has ``n_skipped`` and ``n_rows`` when the job
    has ended. ``shard_counts`` counts distinct members per split.
    """
    mine = _split_members(members, archives, member_path, archive, key)
    if seen is None:
        return mine.join(transcripts, ["split", key], "inner")
    both = mine.join(transcripts.withColumn("_t", F.lit(True)), ["split", key], "left")
    return both.observe(seen, F.count_if(F.col("_t").isNull()).alias("n_skipped"), F.count("_t").alias("n_rows")) \
        .where(F.col("_t").isNotNull()).drop("_t")


def shard_counts(members: DataFrame, transcripts: DataFrame, archives: DataFrame, member_path: str = "path",
                 archive: str = "archive", key: str = "key") -> DataFrame:
    """Per split of ``archives``: distinct members, those with a transcript, and the rest (0 where none match)."""
    m = _split_members(members, archives, member_path, archive, key).select("split", member_path, key).distinct()
    known = transcripts.select("split", key).distinct().withColumn("_t", F.lit(1))
    per = m.join(known, ["split", key], "left").groupBy("split").agg(
        F.count(F.lit(1)).alias("n_members"), F.count("_t").alias("n_matched"))
    return archives.select("split").distinct().join(per, "split", "left").select(
        "split", F.coalesce("n_members", F.lit(0)).alias("n_members"), F.coalesce("n_matched", F.lit(0)).alias("n_matched"),
        (F.coalesce("n_members", F.lit(0)) - F.coalesce("n_matched", F.lit(0))).alias("n_unmatched"))


def _split_members(members: DataFrame, archives: DataFrame, member_path: str, archive: str, key: str) -> DataFrame:
    return members.withColumn(key, stem(F.col(member_path))).join(archives.select("split", archive).distinct(), archive)


def orphans(files: DataFrame, transcribed: DataFrame, key: str = "path") -> DataFrame:
    """Files without a transcript, as rows with text " " and split "orphan"."""
    return (files.select(key).join(transcribed.select(key), key, "left_anti")
            .select(F.lit(ORPHAN_SPLIT).alias("split"), F.col(key),
                    F.lit(ORPHAN_TEXT).alias("transcription")))


def union_splits(frames: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Stack per-split frames (columns may differ), tagging each with its split."""
    out = None
    for name, f in frames:
        g = f.withColumn("split", F.lit(name))
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out


def blank_transcripts(df: DataFrame, raw: str = "raw") -> DataFrame:
    """rows whose transcript is empty after the 7-step cleaner."""
    return df.where(clean_transcript(raw) == F.lit(""))
