"""SURVEY §3.1: convert a corpus shipped as keyed split manifests + a record file.

keyed manifests -> (wav, split) (S8) -> leakage check (J2) -> records (S9)
-> strict lookup of each record's split (J6) -> transcript cleaning (X12) and
class decoding (X13) -> (split, file_name) (X6) -> per-split metadata (K1).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, text
from ..operators import reconcile
from ..sources import readers


def convert(manifests: Mapping[str, DataFrame], records: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """``manifests``: split -> frame with one keyed-JSON document per row (column ``value``);
    a wav listed in several manifests goes to the last one; ``records``: frame with (wav, text, class). Returns (metadata rows, split overlaps)."""
    lists = None
    for i, (split, df) in enumerate(manifests.items()):
        part = readers.explode_keyed_json(df).select(F.col("wav"), F.lit(split).alias("split"), F.lit(i).alias("list"))
        lists = part if lists is None else lists.unionByName(part)
    overlaps = reconcile.split_overlaps(lists, key="wav")
    lookup = lists.select("wav", "list", F.concat(F.lit("data/"), F.col("split"), F.lit("/"), F.col("wav")).alias("file_name"))
    rows = reconcile.strict_lookup(records, lookup, "wav", "file_name", strict=strict, order="list")
    meta = rows.select(F.get(F.split("file_name", "/", 2), 1).alias("file_name"),
                       text.clean_transcript("text").alias("transcription"), *codes.decode_class("class"))
    meta = meta.select(F.get(F.split("file_name", "/", 2), 0).alias("split"),
                       F.get(F.split("file_name", "/", 2), 1).alias("file_name"),
                       "transcription", "topic", "gender", "dialect", "emotion", "age")
    return meta, overlaps
