import sys
import unicodedata

from pyspark.sql import functions as F

from utterflow.functions import text
from utterflow.functions.charclass import jvm_punctuation_class, whitespace_class


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("y")).first()["y"]


def test_whitespace_class_is_python_isspace(spark):
    cps = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    assert len(cps) == 29
    s = "".join(chr(c) for c in cps) + "a"
    got = one(spark, F.regexp_replace("x", whitespace_class(), ""), s)
    assert got == "a"


def test_jvm_punctuation_class_matches_python(spark):
    klass = jvm_punctuation_class(spark)
    punct = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)).startswith("P")]
    assert len(punct) == 842
    assert one(spark, F.regexp_replace("x", klass, ""), "".join(punct) + "ab") == "ab"
    others = "".join(chr(c) for c in range(0x20, 0x3000)
                     if not unicodedata.category(chr(c)).startswith(("P", "C", "Z")))
    assert one(spark, F.regexp_replace("x", klass, ""), others) == others


def words(spark, value):
    return one(spark, text.normalize_words(F.col("x")), value)


def test_normalize_words_edge_rows(spark):
    assert words(spark, "Xin chào, [noise] BẠN!") == ["xin", "chào", "bạn"]
    assert words(spark, "a - b") == ["a", "b"]
    assert words(spark, "a\tb") == ["a\tb"]
    assert words(spark, "...") == []
    assert words(spark, "  <unk>  a   b  ") == ["a", "b"]
    assert words(spark, None) is None


def test_clean_unk(spark):
    assert one(spark, text.clean_unk(F.col("x")), "a<unk>   b") == "a  b"


def test_clean_transcript(spark):
    f = lambda v: one(spark, text.clean_transcript(F.col("x")), v)
    assert f("a - b-c") == "a b c"
    assert f("a \\ b") == "a  b"
    assert f("﻿ x ") == "x"
    assert f("a\n\nb\r\r c") == "a b c"
    assert f(None) is None


def test_clean_tsv_text(spark):
    assert one(spark, text.clean_tsv_text(F.col("x")), "\n A \r\n") == " a \r"


def test_json_transcript(spark):
    doc = '{"results":{"transcripts":[{"transcript":"xin chào"}]}}'
    assert one(spark, text.json_transcript(F.col("x")), doc) == "xin chào"


def test_quick_classes_hold_every_code_point(spark):
    from utterflow.functions.charclass import jvm_whitespace_class
    s = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF)
    assert one(spark, F.regexp_replace("x", jvm_whitespace_class(), ""), s) == "".join(c for c in s if not c.isspace())
    assert one(spark, F.regexp_replace("x", jvm_punctuation_class(spark), ""), s) == \
        "".join(c for c in s if not unicodedata.category(c).startswith("P"))
