"""Transcript cleaning and WER text normalization as built-in Column expressions.

Everything here compiles to JVM expressions (regexp_replace, replace, lower,
split, filter); nothing leaves the executor JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charclass import jvm_punctuation_class, jvm_whitespace_class, punctuation_class, whitespace_chars

# Fixed values that must equal the reference's behaviour.
UNK_TOKEN = "<unk>"
BOM = "﻿"
# Kaldi-style non-words ("<unk>", "[noise]", ...) removed before scoring.
NON_WORD_PATTERN = r"[<\[][^>\]]*[>\]]"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def collapse_whitespace(col: Column | str) -> Column:
    """Every run of Unicode whitespace becomes one space; both ends stripped."""
    x = F.regexp_replace(_c(col), jvm_whitespace_class() + "++", " ")
    return F.btrim(x, F.lit(" "))


def split_words(col: Column | str) -> Column:
    """Split on single spaces and drop empty words (built-in, code-generated)."""
    return F.array_remove(F.split(_c(col), " "), "")


def normalize_words(col: Column | str, punct: str | None = None) -> Column:
    """WER normalizer, returns array<string> of words.

    Order: lowercase; delete non-words in <> or []; runs of >= 2 whitespace ->
    one space; strip whitespace at both ends; delete Unicode punctuation; split
    on " " and drop empty words. A lone tab or newline stays inside a word.
    """
    x = F.lower(_c(col))
    x = F.regexp_replace(x, NON_WORD_PATTERN, "")
    x = F.regexp_replace(x, jvm_whitespace_class() + "{2,}+", " ")
    x = strip_whitespace(x)
    x = F.regexp_replace(x, punct or _session_punct(), "")
    return split_words(x)


def _session_punct() -> str:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return jvm_punctuation_class(spark) if spark is not None else punctuation_class()


def clean_unk(col: Column | str) -> Column:
    """X11: delete <unk>, then one non-overlapping pass of double space -> space."""
    return F.replace(F.replace(_c(col), F.lit(UNK_TOKEN), F.lit("")), F.lit("  "), F.lit(" "))


def clean_transcript(col: Column | str) -> Column:
    """Seven ordered steps (not idempotent by design, like the reference)."""
    x = F.regexp_replace(_c(col), " ?- ?", " ")
    x = F.regexp_replace(x, "\n+", " ")
    x = F.regexp_replace(x, "\r+", " ")
    x = F.regexp_replace(x, " +", " ")
    x = F.replace(x, F.lit("\\"), F.lit(""))
    x = F.replace(x, F.lit(BOM), F.lit(""))
    return strip_whitespace(x)


def strip_whitespace(col: Column | str) -> Column:
    """Python's str.strip(): drop Unicode whitespace at both ends (set trim, ends only)."""
    return F.btrim(_c(col), F.lit(whitespace_chars()))


def clean_tsv_text(col: Column | str) -> Column:
    """Strip only newline characters at both ends, then lowercase."""
    return F.lower(F.btrim(_c(col), F.lit("\n")))


def json_transcript(col: Column | str) -> Column:
    """Results.transcripts[0].transcript of a transcription result document."""
    return F.get_json_object(_c(col), "$.results.transcripts[0].transcript")


def _codepoint_hex(k: Column) -> Column:
    """8 hex digits (UTF-32BE) of a distinct code point for each positive k.

    k is shifted past the surrogate block, so ~1.1M distinct symbols are
    available, far more than one transcript pair can hold.
    """
    cp = F.when(k < F.lit(0xD800), k).otherwise(k + F.lit(0x800))
    return F.lpad(F.hex(cp), 8, "0")


def ids_to_string(ids: Column) -> Column:
    """int array -> string with one character per id (one decode per row)."""
    return F.decode(F.unhex(F.array_join(F.transform(ids, _codepoint_hex), "")), "UTF-32")
