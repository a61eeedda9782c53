"""Benchmark of the headline jobs.

Runs each job on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]: one warm-up, then the median of $BENCH_RUNS runs, the
action being a ``noop`` write (the whole plan runs, nothing is stored).
Prints one JSON line. With $BENCH_EVENT_LOG set to a folder, Spark's
event log is written there for stage and task times (no UI is started).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans.registry import QUERIES  # noqa: E402
from ledgerloom.session import get_spark  # noqa: E402

HEADLINE = [
    "j01_bridge_expand",
    "j03_category_pivot",
    "j04_category_flatten",
    "j09_usage_rank",
    "j12_keep_best",
    "j13_qualify_accounts",
    "j18_contact_rank",
    "j22_replace_changed",
    "j23_latest_per_key",
    "j30_load_cards",
    "j33_exclusions_accounts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus, extra_conf=extra)

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results = {}
    for name in names:
        once(name)
        results[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
