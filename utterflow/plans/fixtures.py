"""Corpus-shaped tables derived from the driver's parquet tables.

The reference works on speech corpora (utterances, transcripts, file listings,
checkpoint logs, frame scores). None of that ships with the test data, so the
tables below are derived from ``documents``, ``events`` and ``embeddings``
with built-in expressions only. Every table covers the *whole* input table and
the *whole* text of every document. The same definitions are spelled in
DuckDB SQL in ``plans/oracle.py``; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, stem
from ..functions.text import collapse_whitespace, split_words
from ..sources.tables import read_table

# Fixed fixture parameters (shared with the DuckDB spelling in plans/oracle.py).
ROWS_PER_SHARD = 250
FRAMES_PER_UTT = 50
BOM = "﻿"
BACKSLASH = "\\"
# Output symbols of CTC classes 1.. (class 0 is the blank).
CTC_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!"


def _split_of(doc_id: Column) -> Column:
    m = doc_id % 10
    return (F.when(m < 8, F.lit("train"))
            .when(m == 8, F.lit("validation"))
            .otherwise(F.lit("test")))


def _raw_variant(doc_id: Column, t: Column) -> Column:
    """Noisy transcript: BOM, dashes, newlines, CRLF, backslashes, tags, blanks."""
    m = doc_id % 7
    return (F.when(m == 0, F.concat(F.lit(BOM), t))
            .when(m == 1, F.replace(t, F.lit(" "), F.lit(" - ")))
            .when(m == 2, F.replace(t, F.lit(" "), F.lit("\n\n")))
            .when(m == 3, F.concat(t, F.lit("\r\n")))
            .when(m == 4, F.replace(t, F.lit(" "), F.lit(" " + BACKSLASH + " ")))
            .when(m == 5, F.concat(F.lit("<unk> "), t, F.lit("   [noise]  ")))
            .when(doc_id % 49 == 6, F.lit("\t "))
            .otherwise(t))


def _class_code(doc_id: Column) -> Column:
    def pick(chars: str, mod: int) -> Column:
        return F.substring(F.lit(chars), (doc_id % mod).cast("int") + 1, 1)

    code = F.concat(F.lit("X"), pick("0123456789Z", 11), pick("MFU", 3), pick("01234Q", 6),
                    pick("NJASTDFHW", 9), pick("CYMOSV", 6))
    return (F.when(doc_id % 97 == 0, F.lit(None).cast("string"))
            .when(doc_id % 97 == 1, F.lit("X0"))
            .otherwise(code))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents scan, spread over the cluster only when it is too narrow.

    Parquet scans are split by bytes (spark.sql.files.maxPartitionBytes), so a
    large table already arrives in thousands of tasks and is not shuffled. A
    table that yields fewer input splits than the cluster has cores (the test
    files are one small file each) is hash-partitioned on doc_id first, so
    regex and edit-distance work over whole texts does not run in one task;
    column pruning passes through that repartition.
    """
    d = read_table(spark, sf_dir, "documents")
    return spread_if_narrow(d, "doc_id")


def spread_if_narrow(df: DataFrame, key: str, scan: DataFrame | None = None) -> DataFrame:
    """Hash-spread ``df`` over 2x the cluster's cores when its scan (``scan``, if that
    is another frame) has fewer splits than cores; leave wide inputs alone (no shuffle)."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        narrow = (df if scan is None else scan).rdd.getNumPartitions() < cores
    except Exception:             # no RDD access (e.g. Spark Connect): leave the scan as it is
        return df
    return df.repartition(2 * cores, key) if narrow else df


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream of files, spread like ``documents``: only where the files that are
    there yield fewer splits than the cluster has cores; a wide stream is not shuffled."""
    scan = read_table(spark, sf_dir, "documents")
    # a glob, because a plain stream path must be a folder and the table may be one file
    stream = spark.readStream.schema(scan.schema).parquet(f"{sf_dir.rstrip('/')}/{{documents.parquet}}")
    return spread_if_narrow(stream, "doc_id", scan)


def utt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One utterance per document, with corpus-style columns."""
    return derive_utt(documents(spark, sf_dir))


def derive_utt(d: DataFrame) -> DataFrame:
    """The ``utt`` columns from a documents frame (batch or streaming)."""
    doc_id = F.col("doc_id")
    split = _split_of(doc_id)
    d = d.withColumn("_text", collapse_whitespace("text"))    # a column of its own, so that it is made once for all uses
    t = F.col("_text")
    return d.select(
        doc_id.alias("utt_id"),
        doc_id.alias("row_ord"),
        F.col("source"),
        F.substring("source", 4, 10).cast("int").alias("source_ord"),
        F.floor(doc_id / F.lit(ROWS_PER_SHARD)).cast("bigint").alias("shard"),
        split.alias("split"),
        F.concat(split, F.lit("/"), F.col("source"), F.lit("_"),
                 F.lpad(doc_id.cast("string"), 6, "0"), F.lit(".wav")).alias("path"),
        t.alias("text"),
        _raw_variant(doc_id, t).alias("raw"),
        (F.when(doc_id % 50 == 0, F.lit(0))
         .when(doc_id % 50 == 1, F.lit(480000))
         .when(doc_id % 50 == 2, F.lit(479999))
         .otherwise((F.col("n_chars") * 137) % 600000)).cast("bigint").alias("n_samples"),
        (F.when(doc_id % 4 == 0, 16000).when(doc_id % 4 == 1, 22050)
         .when(doc_id % 4 == 2, 44100).otherwise(48000)).cast("int").alias("sampling_rate"),
        _class_code(doc_id).alias("class"),
        F.col("lang"),
        F.col("n_chars"),
    )


def hypothesis(doc_id: Column, text: Column) -> Column:
    """Deterministic 'model output': every 11th word wrong, every 7th dropped."""
    words = split_words(text)
    sub = F.transform(words, lambda w, i: F.when((i + doc_id) % 11 == 0, F.lit("zzz")).otherwise(w))
    kept = F.filter(sub, lambda w, i: (i + doc_id) % 7 != 0)
    return F.array_join(kept, " ")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, utt_id, source, ref, hyp): noisy truth and hypothesis per utterance."""
    u = utt(spark, sf_dir)
    return u.select("split", "utt_id", "source", F.col("raw").alias("ref"),
                    hypothesis(F.col("utt_id"), F.col("text")).alias("hyp"))


def gate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pairs`` whose validation split is predicted without an error, which the gate must find suspicious."""
    return pairs(spark, sf_dir).withColumn("hyp", F.when(F.col("split") == "validation", F.col("ref")).otherwise(F.col("hyp")))


def truths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utt(spark, sf_dir).select("split", "utt_id", F.col("raw").alias("sentence"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored hypothesis table (split, utt_id, attempt, pred). Utterances in German have no prediction; of the
    training split every fifth was predicted twice, first without its words' ends."""
    u = utt(spark, sf_dir).where(F.col("lang") != "de")
    again = (F.col("split") == "train") & (F.col("utt_id") % 5 == 0)
    pred = hypothesis(F.col("utt_id"), F.col("text"))
    tries = F.filter(F.array(F.when(again, F.left(pred, F.lit(20))), pred), lambda x: x.isNotNull())
    return u.select("split", "utt_id", F.posexplode(tries).alias("attempt", "pred"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio files that exist on disk: every utterance except the German ones."""
    return utt(spark, sf_dir).where(F.col("lang") != "de").select("path")


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training list: every utterance except the French ones (may name missing files)."""
    return utt(spark, sf_dir).where(F.col("lang") != "fr").select("path")


def split_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, path) membership lists that overlap on purpose, from one scan."""
    u = utt(spark, sf_dir)
    member = [("train", F.col("lang").isin("en", "de")), ("validation", F.col("lang").isin("fr", "de")),
              ("test", (F.col("lang") == "es") | (F.col("n_chars") < 500))]
    return u.select(F.explode(F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in member]),
                                       lambda x: x.isNotNull())).alias("split"), "path")


def lookup_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(wav, file_name, list): two split lists that share the Spanish files; the later list wins."""
    u = utt(spark, sf_dir)
    lists = F.filter(F.array(F.when(F.col("lang") != "fr", F.lit("data/")), F.when(F.col("lang") == "es", F.lit("held/"))),
                     lambda x: x.isNotNull())
    return u.select(basename("path").alias("wav"), F.posexplode(lists).alias("list", "root"), "path") \
        .select("wav", F.concat("root", "path").alias("file_name"), "list")


#: which archives (sources) a split reads; nothing is in the archive of split "extra"
ARCHIVES = tuple([(s, f"src{i}") for s in ("train_raw", "train_refined") for i in range(14)]
                 + [("dev", f"src{i}") for i in range(14, 17)] + [("test", f"src{i}") for i in range(17, 20)]
                 + [("extra", "none")])


def archives(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ARCHIVES), "split string, archive string")


def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(archive, path): files that exist, in the archive of their source."""
    return utt(spark, sf_dir).where(F.col("lang") != "de").select(F.col("source").alias("archive"), "path")


def split_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(split, key, transcription): the dev and test tables name ids of all archives, train archives included."""
    u = utt(spark, sf_dir)
    langs = [("train_raw", ("en", "fr")), ("train_refined", ("en", "es")), ("dev", ("en", "de")), ("test", ("fr", "es"))]
    splits = F.filter(F.array(*[F.when(F.col("lang").isin(*x), F.lit(n)) for n, x in langs]), lambda x: x.isNotNull())
    return u.select(F.explode(splits).alias("split"), stem("path").alias("key"), F.lower("text").alias("transcription"))


def tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, line): 'id<TAB>text' lines keyed by source, so ids repeat (last wins)."""
    u = utt(spark, sf_dir)
    return u.select(F.col("utt_id").alias("line_no"),
                    F.concat(F.col("source"), F.lit("\t"), F.col("text")).alias("line"))


def age_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = utt(spark, sf_dir)
    m = F.col("utt_id") % 6
    pre = (F.when(m == 0, "đông_").when(m == 1, "thành_").when(m == 2, "tú_")
           .when(m == 3, "tuyến_").when(m == 4, "dong_").otherwise("x"))
    return u.select("utt_id", F.concat(pre, F.col("utt_id").cast("string"), F.lit("_a")).alias("id"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(utt, frame, scores): one frame per embedding row, 50 frames per utterance."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.floor(F.col("vec_id") / F.lit(FRAMES_PER_UTT)).cast("bigint").alias("utt"),
                    F.col("vec_id").alias("frame"),
                    F.col("embedding").alias("scores"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, event_id, wer_milli): one evaluation record per event; run = user. Some evaluations have no WER, some runs none at all."""
    ev = read_table(spark, sf_dir, "events")
    none = (F.col("event_id") % 13 == 0) | (F.col("user_id") % 50 == 7)
    return ev.select(F.col("user_id").alias("run"), F.col("event_id"),
                     F.when(~none, F.floor(F.col("value") * 100).cast("bigint") % 1000).alias("wer_milli"))


def make_rule_predictor():
    """Deterministic stand-in model: every 11th word wrong, every 7th dropped.

    Inputs: (utt_id, text) arrays. Mirrors ``hypothesis``.
    """
    import numpy as np

    def predict(ids, texts):
        out = []
        for uid, text in zip(ids, texts):
            words = [w for w in str(text).split(" ") if w != ""]
            kept = [("zzz" if (i + int(uid)) % 11 == 0 else w)
                    for i, w in enumerate(words) if (i + int(uid)) % 7 != 0]
            out.append(" ".join(kept))
        return np.array(out, dtype=object)

    return predict


def result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = utt(spark, sf_dir)
    doc = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("text").alias("transcript")))
                                      .alias("transcripts")).alias("results")))
    return u.select("utt_id", doc.alias("doc"))
