"""From raw documents to packed training sequences.

Each stage calls one training-data operator on all that its predecessor kept;
its result is written as Parquet and read back as the next stage's documents.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterflow.llm.common import documents, row_key, written
from utterflow.llm.line_dedup import apply_bitmaps, free_name, keep_bitmaps
from utterflow.llm.packing import pack
from utterflow.llm.pii import disclosures, sanitise
from utterflow.llm.quality import fit, judged
from utterflow.llm.simhash import fingerprints, with_roots
from utterflow.sources.tables import read_table


def _counted(df: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return df.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in df.columns else df


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rated ones among them, does not reject.

    Every row is judged by its own text: null and empty texts as empty ones, repeated rows and rows without an
    id each; without ratings, or rows, all stay. Further columns are carried under names of their own.
    """
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    out = judged(docs.toDF(*(f"d_{c}" for c in docs.columns)), model, "d_doc_id", "d_text",
                 carry=[f"d_{c}" for c in docs.columns])
    return out.where("keep").select(*(F.col(f"d_{c}").alias(c) for c in docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a later document repeats; null texts stay null.

    No row goes, empty texts and empty tables stay so; rows with one id are one document, rows without an id
    count for nothing and lose nothing; the working column takes a name that is free.
    """
    lines = free_name(docs, "lines")
    out = apply_bitmaps(docs, keep_bitmaps(docs), out=lines)
    return _counted(out.withColumn("text", F.when(F.col("text").isNotNull(), F.col(f"{lines}.text")))).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest id, of several texts with that id
    the one with the smallest key. Rows without an id cannot be named by a group and stay."""
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, row_key(docs, "text"))
    rows = written(fingerprints(keyed.select(F.struct("doc_id", key).alias("row"), "text"), "row", "text"), "fingerprints")
    roots = written(with_roots(rows.select("fp").distinct()), "components")
    kept = rows.where(F.col("id.doc_id").isNotNull()).join(roots, "fp") \
        .groupBy("root").agg(F.min("id").alias("id")).select("id.doc_id", f"id.{key}")
    one = keyed.join(kept, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key]).select(*docs.columns)
    return one.union(docs.where(F.col("doc_id").isNull()))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind and disclosing terms generalised or removed.

    No row goes; null texts stay null; every repeated row, with or without an id, is treated by its text and
    counts as a document; all columns stay, whatever their names.
    """
    return _counted(sanitise(docs, disclosures(docs)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every kept document in the training sequences.

    Repeated rows, rows without an id and null or empty texts have a place each; an empty table has none; columns
    that are not packed are not read.
    """
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("PII", pii),
    ("best-fit packing", best_fit_packing),
]

#: A fitted classifier and near-duplicate components have no SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
