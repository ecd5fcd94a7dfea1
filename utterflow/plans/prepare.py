"""SURVEY §3.2: the training stream, one Catalyst plan.

corpora (P4 unify, J10 ordered concat, F7 exclusions) -> F1 audio length
(before anything expensive) -> R1 labels -> F2 label length -> O1 stable
position -> O3 sample budget -> R3 batches -> R4 padding -> R5 BOS trim ->
R10 rank slices. Publishing (K3) is left to the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import arrays, mix, order
from ..sources import sinks


def training_stream(corpora: Sequence[DataFrame], vocab: DataFrame, batch_size: int, n_ranks: int = 1,
                    steps: int | None = None, excluded: DataFrame | None = None, bos: bool = False,
                    text: str = "transcription", n_samples: str = "n_samples",
                    scratch: str | None = None) -> DataFrame:
    """Each corpus needs: source, source_ord, row_ord, shard, <text>, <n_samples>.

    ``shard`` is a range of ``row_ord`` inside a source (e.g. the input file),
    so positions are computed per bounded block without a global sort. With a
    ``scratch`` folder (shared storage) the encoded rows are written once and
    positions read them back, so the texts are scanned and encoded once.
    """
    df = mix.concat_sources(list(corpora))
    if excluded is not None:
        df = mix.exclude_sources(df, excluded)
    df = df.where(mix.audio_length_ok(F.col(n_samples)))
    # one id per character: F2 is decided without encoding, and only what stays is encoded
    df = df.where(arrays.label_count(F.col(text), bos) < mix.MAX_LABEL_LENGTH)
    df = arrays.encode_labels(df, vocab, text, "labels")
    if bos:
        df = df.withColumn("labels", F.concat(F.array(F.lit(arrays.BOS_ID)), F.col("labels")))
    if scratch is not None:
        df = sinks.materialize(df.drop(text), scratch)
    if steps is not None:
        df = order.sample_budget(df, steps, batch_size, ["source_ord", "row_ord"], "shard")
    else:
        df = order.global_position(df, ["source_ord", "row_ord"], "shard")
    df = arrays.assign_batches(df, batch_size)
    df = arrays.pad_labels(df)
    if bos:
        df = arrays.trim_bos(df)
    return arrays.rank_slices(df, batch_size, n_ranks)
