"""utterflow: speech-corpus preparation and WER scoring as Spark DataFrame plans.

Subpackages
-----------
functions  Column -> Column scalar helpers (paths, transcript cleaning, codes, WAV headers)
sources    readers for manifests, listings, sidecars and tar shards; sinks
operators  DataFrame -> DataFrame operators (reconcile, mix, order, arrays, score, batch)
plans      fixtures derived from the driver's tables, end-to-end plans, the query registry
streaming  Structured Streaming variants of the preparation and scoring plans
"""

__version__ = "0.1.0"
