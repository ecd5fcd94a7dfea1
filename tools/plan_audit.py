"""Print scale-relevant operators of every registered query's physical plan."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from utterflow.plans.catalog import QUERIES  # noqa: E402
from utterflow.session import build_session  # noqa: E402

PATTERNS = ["SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastHashJoin",
            "SortMergeJoin", "ShuffledHashJoin", "Exchange hashpartitioning", "Exchange rangepartitioning",
            "RoundRobinPartitioning", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "PythonMapInArrow",
            "WindowGroupLimit", "ObjectHashAggregate", "SortAggregate"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]", shuffle_partitions=8)
    skip = {"stream_wer", "stream_prepare"}
    for k in sorted(QUERIES):
        if k in skip or (len(sys.argv) > 2 and k not in sys.argv[2:]):
            continue
        df = QUERIES[k](spark, sf)
        p = df._jdf.queryExecution().executedPlan().toString()
        counts = {pat: len(re.findall(re.escape(pat), p)) for pat in PATTERNS}
        print(k, {a: b for a, b in counts.items() if b})


if __name__ == "__main__":
    main()
