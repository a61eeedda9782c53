"""Plan shape of every registered query as it would plan on large inputs.

Broadcast joins are switched off (as for tables above the broadcast
threshold) and each query's physical plan is summarised: hash and range
exchanges, windows, WindowGroupLimit nodes, and whether any Python
evaluation or cartesian product appears.

usage: python tools/plan_report.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(plan: str) -> dict:
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", plan)),
        "windows": len(re.findall(r"\+- Window \[", plan)),
        "window_group_limits": len(re.findall(r"WindowGroupLimit", plan)),
        "python": bool(re.search(r"BatchEvalPython|ArrowEvalPython", plan)),
        "cartesian": bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
    }


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    from ledgerloom.plans.registry import QUERIES
    from ledgerloom.session import get_spark
    spark = get_spark(extra_conf={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                  "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    for name in sorted(QUERIES):
        if name == "j36_run_conversion" or (args and not any(a in name for a in args)):
            continue
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        print(name, summary(plan), flush=True)


if __name__ == "__main__":
    main()
