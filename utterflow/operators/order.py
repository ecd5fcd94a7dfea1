"""Positional operators (O1-O7) without any window over a whole corpus.

A global position over an ordered corpus is computed as
  position = (rows in all earlier blocks) + (row number inside the block)
where a block is (partition keys, leading order keys, shard) and ``shard`` is
a stored, range-based column (``row_ord div rows_per_shard``). The row number
is a window partitioned by the block, so each block is one bounded sort; the
block offsets come from one table of block sizes, pre-aggregated per map task:
one row per block, so rows / ROWS_PER_SHARD of them and one per leading key.
The join back to the data is on the block key the window already
hash-partitioned by, so the big side is not shuffled again; AQE turns it into
a broadcast join when the measured table is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SHARD = 100_000         # rows in a block: one sort
SHARDS_PER_GROUP = 1_024         # blocks in a group: one window over block sizes
BROADCAST_ROWS = 100_000         # a budget's blocks are broadcast up to so many rows


def global_position(df: DataFrame, order_cols: Sequence[str], shard_col: str = "shard",
                    partition_cols: Sequence[str] = (), name: str = "pos",
                    rows_per_shard: int | None = None) -> DataFrame:
    """O1/O2: 0-based stable position in (order_cols) order, restarting per partition_cols.

    ``shard_col`` must be a range of the last order column within the leading
    ones (e.g. shard = row_ord div ROWS_PER_SHARD inside a source). With
    ``rows_per_shard`` the shard is derived that way (a stored, repeatable
    range, never the partition id); real corpora use file-sized shards.
    """
    *lead, last = list(order_cols)
    if rows_per_shard is not None:
        df = df.withColumn(shard_col, F.floor(F.col(last) / F.lit(rows_per_shard)).cast("bigint"))
    part = list(partition_cols)
    block = [*part, *lead, shard_col]
    ranked = df.withColumn("_local", F.row_number().over(Window.partitionBy(*block).orderBy(last)) - 1)
    # block sizes by partial aggregation: each map task sends one row per block
    # it saw, so this branch re-reads only the block columns and shuffles a
    # table the size of the block count, never the rows themselves
    counts = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _block_offsets(counts, part, lead, shard_col)

    return _join_null_safe(ranked, offsets, block).withColumn(
        name, (F.col("_off") + F.col("_local")).cast("bigint")).drop("_off", "_local")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null (a null key is a group too)."""
    r = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_k{i}"]) for i, k in enumerate(keys)]
    return left.join(r, cond, "inner").drop(*[f"_k{i}" for i in range(len(keys))])


def _cumulative(df: DataFrame, part: list[str], order_by: list[str], value: str) -> Column:
    w = Window.partitionBy(*part) if part else Window.partitionBy()
    w = w.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(w) - F.col(value)


def _block_offsets(counts: DataFrame, part: list[str], lead: list[str], shard_col: str) -> DataFrame:
    """Rows before each block, in two levels so no window spans all blocks.

    Level 1: prefix sums over the shards of a group, SHARDS_PER_GROUP
    consecutive shards of one source, so a source's block list is split however
    long it is. Level 2: prefix sums over the groups' totals (one row per
    source and group), derived from the same counts. Leading keys should be
    few: every one is a row of level 2.
    """
    sized = counts.withColumn("_grp", F.floor(F.col(shard_col) / F.lit(SHARDS_PER_GROUP)))
    group = [*part, *lead, "_grp"]
    within = sized.select(*group, shard_col, _cumulative(sized, group, [shard_col], "_n").alias("_o1"))
    totals = sized.groupBy(*group).agg(F.sum("_n").alias("_t"))
    before = totals.select(*group, _cumulative(totals, part, [*lead, "_grp"], "_t").alias("_o2"))
    return (_join_null_safe(within, before, group)
            .select(*part, *lead, shard_col, (F.col("_o1") + F.col("_o2")).alias("_off")))


def budget_rows(steps: int, batch_size: int) -> int:
    """Rows that ``steps`` optimizer steps take: accumulation is 1 for batch >= 8, else 8 // batch (the reference's rule)."""
    return steps * batch_size * (1 if batch_size >= 8 else 8 // batch_size)


def sample_budget(df: DataFrame, steps: int, batch_size: int, order_cols: Sequence[str], shard_col: str = "shard",
                  name: str = "pos", rows_per_shard: int | None = None) -> DataFrame:
    """O3: the first ``budget_rows`` rows of the ordered stream, with their positions.

    Arguments as for ``global_position``. Block sizes are counted first; only
    blocks that begin within the budget are kept, by a join before the window,
    so rows are numbered of the budget and one block more, and no other row is
    shuffled where the kept blocks are broadcast (there is a row in each, so
    they are no more than the budget).
    """
    n = budget_rows(steps, batch_size)
    *lead, last = list(order_cols)
    if rows_per_shard is not None:
        df = df.withColumn(shard_col, F.floor(F.col(last) / F.lit(rows_per_shard)).cast("bigint"))
    block = [*lead, shard_col]
    counts = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    kept = _block_offsets(counts, [], lead, shard_col).where(F.col("_off") < n)
    rows = _join_null_safe(df, F.broadcast(kept) if n <= BROADCAST_ROWS else kept, block)
    local = F.row_number().over(Window.partitionBy(*block).orderBy(last)) - 1
    return rows.withColumn(name, (F.col("_off") + local).cast("bigint")).where(F.col(name) < n).drop("_off")


def head_tail(df: DataFrame, group_cols: Sequence[str], order_col: str, k: int = 5) -> DataFrame:
    """First k and last k rows per group in input order (overlap allowed).

    Two ranked windows filtered to <= k; Spark plans them as WindowGroupLimit,
    so each task keeps only k rows per group before the final sort.
    """
    g = list(group_cols)
    asc = F.row_number().over(Window.partitionBy(*g).orderBy(F.col(order_col).asc()))
    desc = F.row_number().over(Window.partitionBy(*g).orderBy(F.col(order_col).desc()))
    head = df.withColumn("_r", asc).where(F.col("_r") <= k).select("*", F.lit("head").alias("end"))
    tail = df.withColumn("_r", desc).where(F.col("_r") <= k).select("*", F.lit("tail").alias("end"))
    return head.unionByName(tail).withColumnRenamed("_r", "rank_in_end")


def _best(step_col: str, wer_col: str) -> Column:
    """(wer, step) of the lowest WER, ties by step; a null or NaN WER (no reference words) never wins."""
    known = F.col(wer_col).isNotNull() & ~F.isnan(F.col(wer_col).cast("double"))
    return F.min(F.when(known, F.struct(F.col(wer_col).alias("wer"), F.col(step_col).alias("step"))))


def best_checkpoint(metrics: DataFrame, run_col: str = "run", step_col: str = "step",
                    wer_col: str = "wer") -> DataFrame:
    """Per run the step with the lowest WER; ties go to the earliest step.

    A null or NaN WER is no result; a run with no other has a null step and WER.
    """
    return (metrics.groupBy(run_col).agg(_best(step_col, wer_col).alias("_b"))
            .select(run_col, F.col("_b.step").alias("best_step"), F.col("_b.wer").alias("best_wer")))


def retain_checkpoints(metrics: DataFrame, limit: int, run_col: str = "run",
                       step_col: str = "step", wer_col: str = "wer") -> DataFrame:
    """Keep the best checkpoint plus the newest ones, ``limit`` in total per run.

    Checkpoints are the distinct (step, WER) rows of the log; one without a WER
    (null or NaN) can be among the newest but is never the best.
    The best step is a partial aggregate and the newest steps a rank-limited
    window (planned as WindowGroupLimit before and after the shuffle), so a
    run with a huge log never sorts more than ``limit`` rows per map task.
    """
    best = best_checkpoint(metrics, run_col, step_col, wer_col).where(F.col("best_step").isNotNull()).select(
        F.col(run_col), F.col("best_step").alias(step_col), F.col("best_wer").alias(wer_col), F.lit(True).alias("is_best"))
    recent = F.row_number().over(Window.partitionBy(run_col).orderBy(F.col(step_col).desc(), F.col(wer_col).asc_nulls_last()))
    newest = (metrics.select(run_col, step_col, wer_col).withColumn("_r", recent)
              .where(F.col("_r") <= limit).drop("_r").withColumn("is_best", F.lit(False)))
    cand = newest.unionByName(best).groupBy(run_col, step_col, wer_col).agg(F.max("is_best").alias("is_best"))
    order = Window.partitionBy(run_col).orderBy(F.col("is_best").desc(), F.col(step_col).desc(), F.col(wer_col).asc_nulls_last())
    return (cand.withColumn("keep_rank", F.row_number().over(order))
            .where(F.col("keep_rank") <= limit))


def thin_steps(df: DataFrame, every: int, step_col: str = "step") -> DataFrame:
    """Keep log/eval rows whose step is a multiple of ``every``."""
    return df.where(F.col(step_col) % every == 0)
