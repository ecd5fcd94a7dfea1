"""Labelled rows for the classifiers: hold-out split and a bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLD_OUT_FOLDS = 5


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text is divisible by five; null ids are not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HOLD_OUT_FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    max_rows: int) -> DataFrame:
    """(text, y, fold) of about ``max_rows`` labelled rows that are not held out, all of them if fewer.

    Rows are taken by a hash of their id, so the sample does not depend on how
    the table is laid out. Null labels don't count; of several labels of one id
    the largest does. Of equal texts with equal labels one stays, so copies do
    not weigh more than other texts. The sampled ids are broadcast: their number is bounded by
    ``max_rows`` whatever the table's size.
    """
    rated = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("double").alias("y"))
    n = max(1, rated.count())
    few = rated.withColumn("_u", F.xxhash64(F.col("_id"), F.lit("sample"))) \
        .where(F.pmod("_u", F.lit(n)) < max_rows)
    return docs.select(F.col(id_col).alias("_doc"), F.coalesce(text_col, F.lit("")).alias("text")) \
        .join(F.broadcast(few), F.col("_doc") == F.col("_id")) \
        .select("text", "y", F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(2)).cast("int").alias("fold")) \
        .dropDuplicates(["text", "y"])
