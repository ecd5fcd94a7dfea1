"""Registry of the training-data queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embedding_dedup, line_dedup, topk_search, warc
from .bpe import op2_byte_bpe
from .embedding_dedup import op10_embedding_near_dedup
from .line_dedup import op5_line_dedup
from .packing import op1_best_fit_packing
from .periodic_runs import op13_periodic_runs
from .permutation_index import op12_permutation_index
from .pii import op9_pii
from .quality import op6_quality_classifier
from .simhash import op3_simhash_near_dedup
from .topk_search import op7_exact_topk
from .toxicity import op4_toxicity
from .warc import op8_warc
from .whitening import op11_whitening

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_exact_topk": op7_exact_topk,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_whitening": op11_whitening,
    "op12_permutation_index": op12_permutation_index,
    "op13_periodic_runs": op13_periodic_runs,
}

LLM_ORACLE_SQL: dict[str, str] = {
    "op5_line_dedup": line_dedup.ORACLE,
    "op7_exact_topk": topk_search.ORACLE,
    "op8_warc": warc.ORACLE,
    "op10_embedding_near_dedup": embedding_dedup.ORACLE,
}
