"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) with local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (the whole plan
executes, nothing is collected). Every query is built and run REPEATS times
(a fresh plan each time, so no shuffle output is reused) and the fastest run
is reported, which damps noise from other tenants of the machine.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from utterflow.plans.catalog import QUERIES  # noqa: E402
from utterflow.session import build_session  # noqa: E402

HEADLINE = [
    "wer_by_split",          # flagship: normalize + word edit distance + corpus WER
    "wer_pairs",
    "norm_words",
    "clean_transcript",
    "proj_metadata",
    "encode_labels",
    "pad_labels",
    "global_position",
    "join_split_assign",
    "set_split_disjoint",
    "join_shard_transcripts",
    "src_json_records",
    "src_tsv_transcripts",
    "retain_checkpoints",
    "ctc_greedy",
    "sink_metadata_csv",
    "stream_wer",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in sys.argv[1:] if q in QUERIES]
    spark = build_session(f"local[{cpus}]", app="utterflow-bench", shuffle_partitions=max(cpus, 8))
    # warm-up on the smallest tables (JIT, Python workers); not timed
    small = re.sub(r"sf[0-9.]+$", "sf0.001", sf_dir.rstrip("/"))
    if os.path.isdir(small):
        QUERIES["wer_by_split"](spark, small).write.format("noop").mode("overwrite").save()
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    times = {}
    for name in only or HEADLINE:
        best = None
        for _ in range(repeats):
            t0 = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.time() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": m.group(1) if m else sf_dir, "cpus": cpus,
                      "repeats": repeats, "stat": "min"}))
    spark.stop()


if __name__ == "__main__":
    main()
