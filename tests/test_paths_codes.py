from pyspark.sql import functions as F

from utterflow.functions import codes, paths


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "x string").select(col.alias("y")).first()["y"]


def test_stem_edge_rows(spark):
    cases = {"a.b.wav": "a.b", ".wav": ".wav", "x": "x", "a.": "a", "..wav": "..wav", "d/e/f.txt": "f",
             "a..b": "a.", "...a.b": "...a", ".a.b": ".a", "a.b.": "a.b"}
    for k, v in cases.items():
        assert one(spark, paths.stem(F.col("x")), k) == v, k


def test_split_once(spark):
    df = spark.createDataFrame([("train/x/y.wav",), ("x",)], "x string")
    a, b = paths.split_once("x")
    rows = df.select(a.alias("a"), b.alias("b")).collect()
    assert [tuple(r) for r in rows] == [("train", "x/y.wav"), ("x", None)]


def test_unflatten_flatten_prefix(spark):
    assert one(spark, paths.unflatten(F.col("x")), "data/id00000_00000.wav") == "id00000/00000.wav"
    assert one(spark, paths.flatten(F.col("x")), "a/b/c.wav") == "a_b_c.wav"
    assert one(spark, paths.id_prefix(F.col("x")), "abcdefghijklmnopq") == "abcdefghijklmn"
    assert one(spark, paths.id_prefix(F.col("x")), "short") == "short"
    assert one(spark, paths.strip_prefix(F.col("x"), "corpus/"), "corpus/train/a.ogg") == "train/a.ogg"
    assert one(spark, paths.swap_extension(F.col("x"), ".wav", ".txt"), "a.wav.wav") == "a.txt.txt"


def test_age_class(spark):
    df = spark.createDataFrame([("đông_1_2",), ("dong_1_2",)], "x string")
    c, p = paths.age_class("x")
    rows = [tuple(r) for r in df.select(c, p).collect()]
    assert rows == [("kindergarten", "audio_MDD/kindergarten/đông/1_2.wav"),
                    ("primaryschool", "audio_MDD/primaryschool/dong_1_2.wav")]


def test_decode_class(spark):
    df = spark.createDataFrame([("X0M1NY",), ("X0",), (None,), ("X9QZZZ",)], "x string")
    rows = [tuple(r) for r in df.select(*codes.decode_class("x")).collect()]
    assert rows[0] == ("news", "male", "central dialect", "neutral", "young")
    assert rows[1] == ("news", None, None, None, None)
    assert rows[2] == (None,) * 5
    assert rows[3] == ("healthcare", None, None, None, None)
