"""Corpus unification, mixing and length filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
TARGET_RATE = 16000
MAX_AUDIO_SAMPLES = 30 * TARGET_RATE     # 480000, both bounds exclusive
MAX_LABEL_LENGTH = 448                   # strictly below


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep only ``cols`` (column pruning reaches the scan)."""
    return df.select(*cols)


def remove_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; unlike ``DataFrame.drop`` an unknown name is an error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (error on unknown source names, like the reference)."""
    missing = [c for c in mapping if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumnsRenamed(dict(mapping))


def unify(df: DataFrame, mode: int, audio: str = "audio") -> DataFrame:
    """Bring a corpus to the canonical (audio, transcription) shape.

    mode 0: as is; 1: keep audio, transcription; 2: keep audio, sentence and
    rename sentence -> transcription; anything else is an error.
    """
    if mode == 0:
        return df
    if mode == 1:
        return df.select(audio, "transcription")
    if mode == 2:
        return df.select(audio, F.col("sentence").alias("transcription"))
    raise ValueError(f"unknown unify mode {mode}")


def cast_audio(df: DataFrame, audio: str = "audio", rate: int = TARGET_RATE) -> DataFrame:
    """P5: declare the audio at ``rate`` Hz; the sample count is rescaled.

    n_samples_<rate> = round(n * rate / source_rate), half up; the stored
    samples are untouched. A sampling rate of zero or less is no rate: its
    count is null.
    """
    a = F.col(audio)
    n = a["n_samples"].cast("bigint")
    src = a["sampling_rate"].cast("bigint")
    scaled = F.when(src > 0, F.floor(F.try_divide(n * F.lit(2 * rate) + src, F.lit(2) * src)).cast("bigint"))
    return df.withColumn(audio, F.struct(a["path"].alias("path"), n.alias("n_samples"),
                                         a["sampling_rate"].alias("source_rate"),
                                         F.lit(rate).alias("sampling_rate"),
                                         scaled.alias("n_samples_resampled")))


def to_metadata(df: DataFrame, mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """Final metadata columns in order: [(source column, output name), ...]."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping])


def audio_length_ok(n_samples: Column, max_samples: int = MAX_AUDIO_SAMPLES) -> Column:
    """F1 predicate: 0 < n < max (both ends exclusive)."""
    return (n_samples > 0) & (n_samples < max_samples)


def label_length_ok(labels: Column, max_len: int = MAX_LABEL_LENGTH) -> Column:
    """F2 predicate: size(labels) < max (zero allowed)."""
    return F.size(labels) < max_len


def filter_then_drop(df: DataFrame, helper: str, predicate: Column) -> DataFrame:
    """filter on a helper column, then drop it."""
    return df.where(predicate).drop(helper)


def concat_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Ordered bag union of corpora; order is carried by (source_ord, row_ord)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def mix_optional(base: Sequence[DataFrame], optional: Sequence[DataFrame], include: bool) -> DataFrame:
    """F8: the base corpus group, plus the optional group when the flag is on."""
    return concat_sources(list(base) + (list(optional) if include else []))


def exclude_sources(df: DataFrame, excluded: DataFrame, key: str = "source") -> DataFrame:
    """drop corpora listed in an exclusion table (left anti join).

    No hint: Spark broadcasts the list when its measured size is below the
    broadcast threshold (a handful of names always is) and shuffles otherwise.
    """
    return df.join(excluded.select(key).distinct(), on=key, how="left_anti")


def corpus_mix(df: DataFrame, source: str = "source") -> DataFrame:
    """A5: rows per source plus the grand total (rollup; ``is_total`` tells the total row,
    whose source is null, from rows without a source)."""
    return df.rollup(source).agg(F.count(F.lit(1)).alias("n_rows"), (F.grouping(source) == 1).alias("is_total"))
