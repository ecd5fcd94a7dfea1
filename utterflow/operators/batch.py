"""User-function surfaces (U1-U6): row maps, filters, batched maps, pluggable predictors.

U1 (``map(fn)`` row transforms) and U3 (``filter(fn, input_columns=...)``)
are native Column expressions throughout: ``functions/*`` for maps and
``operators.mix.audio_length_ok`` / ``label_length_ok`` for predicates, so
Catalyst can push and prune them. U4 (a generator-backed source builder) is
the tar-shard DataSource in ``sources/tarshards.py``. The functions below
exist for code Spark cannot see into (a model, an opaque per-batch
transform): rows reach Python in Arrow batches; parallelism is the number
of partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str,
                batch_size: int | None = None) -> DataFrame:
    """``map(fn, batched=True, batch_size=n)`` as ``mapInPandas``.

    Arrow batches arriving in a task are re-cut into batches of exactly
    ``batch_size`` rows (the last one of a partition may be shorter), so
    ``fn`` sees the batch size it was written for without changing any
    session setting. Parallelism is the number of partitions.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not batch_size:
            for b in batches:
                yield fn(b)
            return
        pending: list[pd.DataFrame] = []
        held = 0
        for b in batches:
            pending.append(b)
            held += len(b)
            if held < batch_size:
                continue
            buf = pd.concat(pending, ignore_index=True)
            cut = (len(buf) // batch_size) * batch_size
            for i in range(0, cut, batch_size):
                yield fn(buf.iloc[i:i + batch_size].reset_index(drop=True))
            pending, held = ([buf.iloc[cut:].reset_index(drop=True)], len(buf) - cut) if cut < len(buf) else ([], 0)
        if held:
            yield fn(pd.concat(pending, ignore_index=True))

    return df.mapInPandas(run, schema)


def score_batches(make_predict_fn: Callable, inputs: list[Column | str], return_type: T.DataType,
                  batch_size: int) -> Column:
    """A pluggable predictor applied in batches of ``batch_size`` rows.

    ``make_predict_fn`` is called once per Python worker (loads the model);
    the returned function maps numpy input arrays to a list/array of outputs.
    U6 (row-at-a-time fallback) is the same call with batch_size=1.
    """
    from pyspark.ml.functions import predict_batch_udf
    udf = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size)
    return udf(*[F.col(c) if isinstance(c, str) else c for c in inputs])
