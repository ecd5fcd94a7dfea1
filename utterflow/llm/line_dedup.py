"""Line deduplication with DataFrame operations only.

Occurrences are range-partitioned by (line hash, document): Spark samples the
borders, so a line that a third of all documents hold spans as many ranges as it
has rows for. Each range is sorted by hash, document and position, and the
stream yields each line's first occurrence in each document. Those are
pre-aggregated to the documents and the last document of a line before they are
shuffled again, and the occurrences of repeated lines outside the last document
become the zeros of per-document keep bitmaps. Text is never shuffled to decide
anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import UPPER, WHITE, ascii_lower, documents, spread_key

def _text(c: str):
    return F.coalesce(F.col(c), F.lit(""))


def line_occurrences(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, rev, pos, h1, h2) of every line whose key has at least ``min_chars`` code points.

    ``rev`` (a hash of the text) tells apart different texts under one id;
    h1 and h2 are independent 64-bit hashes of the key.
    """
    # rev before the lines: beside the generator it would be taken once for every line
    docs = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("rev"), ascii_lower(_text(text_col)).alias("low"))
    lines = docs.select("id", "rev", F.posexplode(F.split("low", "\n")).alias("pos", "line"))
    keys = lines.select("id", "rev", "pos", F.btrim("line", F.lit(WHITE)).alias("key")) \
        .where(F.char_length("key") >= min_chars)
    return keys.select("id", "rev", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def keep_bitmaps(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, rev, n_dropped, keep) of every document that loses lines.

    A line whose key (trimmed of white space, A-Z lower-cased) has at least
    ``min_chars`` code points and is in at least ``min_docs`` documents stays
    only in the document with the largest id. ``keep`` is a compressed bitmap:
    (word, bits) pairs in order, bit ``i`` of word ``w`` for line ``64 w + i``,
    without the words of which every line stays.
    Documents are told apart by id: repeated rows count once, rows with a null
    id count for nothing and lose nothing.
    """
    order = ["h1", "h2", "id"]
    occ = line_occurrences(df, id_col, text_col, min_chars).repartitionByRange(*order).sortWithinPartitions(*order, "rev", "pos")
    marked = occ.withColumn("nth", F.row_number().over(W.partitionBy(*order).orderBy("rev", "pos"))) \
        .withColumn("part", spread_key("h1"))
    repeated = marked.where("nth = 1").groupBy("h1", "h2") \
        .agg(F.count("*").alias("n_docs"), F.max("id").alias("last")).where(F.col("n_docs") >= min_docs)
    last = repeated.select("h1", "h2", "last", spread_key("h1").alias("part"))
    dropped = marked.join(last, ["part", "h1", "h2"]).where("id < last") \
        .select("id", "rev", F.expr("pos div 64").cast("int").alias("word"), (F.col("pos") % 64).alias("bit")).distinct()
    words = dropped.groupBy("id", "rev", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("drop"))
    return words.groupBy("id", "rev").agg(
        F.sum(F.bit_count("drop")).alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("drop").alias("bits")))).alias("keep")) \
        .withColumnRenamed("id", id_col)


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  out: str = "_lines") -> DataFrame:
    """All columns of ``df`` and struct ``out`` (text reduced to the lines kept, n_lines, n_dropped).

    Rows with nothing to drop keep their text as it is (null: empty). ``out``
    must be no column of ``df``; ``free_name`` finds one.
    """
    if out in df.columns:
        raise ValueError(f"column {out!r} exists already")
    full = F.expr("""flatten(transform(keep, (x, i) -> concat(
        array_repeat(-1L, x.word - coalesce(get(keep, i - 1).word, -1) - 1), array(x.bits))))""")
    maps = bitmaps.select(F.col(id_col).alias("m_id"), F.col("rev").alias("m_rev"),
                          F.col("n_dropped").alias("m_dropped"), full.alias("m_keep"))
    inner = {c: f"d_{i}" for i, c in enumerate(df.columns)}
    text = _text(inner[text_col])
    here = df.toDF(*inner.values()).withColumn("h_text", F.xxhash64(text))
    kept = F.filter(F.split(text, "\n"), lambda line, i: F.getbit(
        F.coalesce(F.get(F.col("m_keep"), F.floor(i / 64).cast("int")), F.lit(-1).cast("long")), i % 64) == 1)
    lines = F.struct(
        F.when(F.col("m_keep").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("text"),
        (F.char_length(text) - F.char_length(F.translate(text, "\n", "")) + 1).cast("long").alias("n_lines"),
        F.coalesce("m_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    return here.join(maps, (F.col(inner[id_col]) == F.col("m_id")) & (F.col("h_text") == F.col("m_rev")), "left") \
        .select(*(F.col(n).alias(c) for c, n in inner.items()), lines.alias(out))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document and the digest of what stays."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(
        "doc_id", "_lines.n_lines", "_lines.n_dropped",
        F.sha2(F.col("_lines.text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key
      FROM l),
g AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, last_doc IS NOT NULL AND doc_id < last_doc AS dropped FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
