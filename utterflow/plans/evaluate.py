"""SURVEY §3.3: WER evaluation of stored predictions (or a pluggable predictor).

truths ⋈ predictions by key (J11) -> cardinality check (F10) -> normalize both
sides and count word edits (X16, A1) -> WER per split (A3) -> range gate (F11)
-> first/last k pairs of every suspicious split (O4).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import batch, score
from ..session import scratch_path
from ..sources import sinks


@dataclass
class EvalReport:
    wer: DataFrame        # split, n_pairs, edits, ref_words, n_empty_ref, wer, status
    check: DataFrame      # split, truth_only, pred_only, matched, repeated, ok
    samples: DataFrame    # split, end, rank_in_end, order key, reference, prediction (suspicious splits only)


def evaluate(truths: DataFrame, predictions: DataFrame, keys: Sequence[str] = ("split", "utt_id"),
             truth_col: str = "sentence", pred_col: str = "pred", order_col: str = "utt_id",
             k: int = 5, attempt_col: str | None = None) -> EvalReport:
    """A key predicted more than once is an error, unless ``attempt_col`` says which prediction counts (the largest).

    Truths and predictions are read once, here: WER and the cardinality check
    are aggregates of the same pass, a row per split, kept in the shared folder.
    Only samples of suspicious splits, if there are any, read them again.
    """
    k_ = list(keys)
    attempt = [attempt_col] if attempt_col else []
    t, p = truths.select(*k_, truth_col), predictions.select(*k_, *attempt, pred_col)
    summary = sinks.materialize(score.evaluated(t, p, truth_col, pred_col, k_, attempt_col),
                                scratch_path(truths.sparkSession, f"evaluation-{uuid.uuid4().hex}"))
    wer = score.wer_gate(summary.where("n_pairs > 0").select(k_[0], "n_pairs", "edits", "ref_words", "n_empty_ref", "wer"))
    check = summary.select(k_[0], "truth_only", "pred_only", "matched", "repeated", "ok")
    pairs = score.join_pred_truth(t, p, k_, attempt_col).select(*k_, F.col(truth_col).alias("ref"), F.col(pred_col).alias("hyp"))
    samples = score.gate_samples(pairs, wer, k, k_[0], order_col)
    return EvalReport(wer=wer, check=check, samples=samples)


def predict(df: DataFrame, make_predict_fn: Callable, inputs: Sequence[str], batch_size: int,
            out: str = "pred") -> DataFrame:
    """Add a prediction column from a user model, ``batch_size`` rows per call."""
    return df.withColumn(out, batch.score_batches(make_predict_fn, list(inputs), T.StringType(), batch_size))
