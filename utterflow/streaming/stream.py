"""Structured Streaming variants (T1 with O2 and R3, T2).

The reference pulls lazily from a bounded, ordered corpus; here the same
stateless preparation and the running WER are streaming queries over a file
source. ``availableNow`` processes everything present and stops, so a run
is a bounded job that resumes from its checkpoint after a failure.
"""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import arrays, order, score


def prepare_stream(rows: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """A stream of prepared rows (stateless maps and filters) -> parquet sink; returns the sink as a batch read."""
    q = (rows.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return rows.sparkSession.read.parquet(out_path)


def numbered_stream(rows: DataFrame, out_path: str, checkpoint: str, order_cols: Sequence[str], partition_col: str = "split",
                    rows_per_shard: int = order.ROWS_PER_SHARD, batch_size: int | None = None) -> DataFrame:
    """O2 (and R3) in the stream: rows with their position in their split, counted on over micro-batches and restarts.

    Rows of an earlier micro-batch come first; within one they are in the order
    of ``order_cols``. A micro-batch is numbered as a table is (see
    ``order.global_position``), so a split that holds most rows is still spread,
    and begins where the one before it ended: that is a table of one row a
    split, written with every micro-batch. A retried micro-batch begins at the same
    place and rewrites its own folder, so no position is skipped or given twice.
    With ``batch_size`` rows have ``batch`` and ``slot``, too.
    """
    base = out_path.rstrip("/")
    spark = rows.sparkSession

    def begun(epoch: int) -> DataFrame:
        schema = f"_split {rows.schema[partition_col].dataType.simpleString()}, _next long"
        if epoch == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{base}/next/epoch={epoch - 1}")

    def sink(batch: DataFrame, epoch: int) -> None:
        before = begun(epoch)
        local = order.global_position(batch, order_cols, "_block", [partition_col], "_in_batch", rows_per_shard).drop("_block")
        at = F.coalesce("_next", F.lit(0)).cast("long")
        placed = local.join(before, local[partition_col].eqNullSafe(before["_split"]), "left") \
            .withColumn("pos", at + F.col("_in_batch")).drop("_split", "_next", "_in_batch")
        if batch_size:
            placed = arrays.assign_batches(placed, batch_size)
        placed.write.mode("overwrite").parquet(f"{base}/rows/epoch={epoch}")
        now = spark.read.parquet(f"{base}/rows/epoch={epoch}").groupBy(F.col(partition_col).alias("_split")) \
            .agg((F.max("pos") + 1).alias("_next"))
        now.unionByName(before).groupBy("_split").agg(F.max("_next").alias("_next")) \
            .write.mode("overwrite").parquet(f"{base}/next/epoch={epoch}")

    q = (rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/rows").drop("epoch")


def stream_session(spark: SparkSession, state_partitions: int = 4) -> SparkSession:
    """A session of the same application for a query with small state.

    The state width is recorded in the checkpoint at the first start; setting
    it on a session of its own leaves queries planned elsewhere alone.
    """
    own = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def running_wer(pairs_stream: DataFrame, out_path: str, checkpoint: str, group_col: str = "split") -> DataFrame:
    """WER per split maintained while (reference, hypothesis) pairs arrive.

    State is one (edits, words, pairs) row per split; read the stream in a
    ``stream_session`` so that it lives in few partitions. Each micro-batch
    writes its complete result to its own ``epoch=<n>`` folder (a retried batch
    rewrites the same folder), so a reader never sees a half-replaced table;
    ``latest_wer`` returns the newest epoch.
    """
    edits = score.word_edits(pairs_stream, keys=(group_col, "utt_id"))
    agg = score.corpus_wer(edits, [group_col])

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")

    q = (agg.writeStream.outputMode("complete").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_wer(pairs_stream.sparkSession, out_path)


def latest_wer(spark: SparkSession, out_path: str) -> DataFrame:
    """The newest complete result written by ``running_wer`` (one row per split); older epochs are only listed."""
    epochs = [int(m[1]) for m in (re.search(r"/epoch=(\d+)/", f) for f in spark.read.parquet(out_path).inputFiles()) if m]
    return spark.read.parquet(f"{out_path.rstrip('/')}/epoch={max(epochs)}")
