"""Per-stage timings of one registered query from Spark's event log (no UI).

Usage: python tools/stage_profile.py <query> [sf_dir]
The event log goes to a fresh folder under /tmp; stages are listed with wall
time, task count and task-time skew (max / median), the signal for stragglers.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from utterflow.plans.catalog import QUERIES  # noqa: E402
from utterflow.session import build_session  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="utterflow-events-")
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    small = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(small):                      # warm-up (JIT, Python workers); listed as early stages
        QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    t0 = time.time()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()
    stages, tasks = {}, {}
    for path in glob.glob(os.path.join(logdir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, encoding="utf-8") as f:
            for line in f:
                try:
                    ev = json.loads(line)
                except json.JSONDecodeError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    stages[info["Stage ID"]] = (info["Stage Name"], info["Number of Tasks"],
                                                info.get("Completion Time", 0) - info.get("Submission Time", 0))
                elif kind == "SparkListenerTaskEnd":
                    ti = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    print(f"{name}: {wall:.2f}s wall, {len(stages)} stages")
    for sid in sorted(stages):
        sname, n, ms = stages[sid]
        t = tasks.get(sid, [0])
        skew = max(t) / max(statistics.median(t), 1)
        print(f"  stage {sid:3d} {ms / 1000:7.2f}s tasks={n:4d} max_task={max(t) / 1000:6.2f}s skew={skew:5.1f} {sname[:60]}")


if __name__ == "__main__":
    main()
