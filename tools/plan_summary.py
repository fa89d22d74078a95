"""Summarise the executed physical plans of registered queries.

usage: python tools/plan_summary.py [sf_dir] [key ...]   (default: bench's headline set at sf0.1)

Runs each query (noop write) so AQE's final plan is shown, then prints per
query: shuffle exchanges, broadcast exchanges, join strategies, partial
aggregates / partial window-group limits (map-side reduction before a shuffle)
and the columns each Parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from curdle.plans.queries import all_queries  # noqa: E402
from curdle.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    ops = Counter()
    for name in (
        "ShuffleExchange",
        "Exchange hashpartitioning",
        "Exchange rangepartitioning",
        "Exchange SinglePartition",
        "BroadcastExchange",
        "BroadcastHashJoin",
        "SortMergeJoin",
        "ShuffledHashJoin",
        "BroadcastNestedLoopJoin",
        "CartesianProduct",
        "WindowGroupLimit",
        "ReusedExchange",
    ):
        ops[name] = plan.count(name)
    ops["partial aggregates"] = len(re.findall(r"functions=\[(?:partial_|merge_)", plan))
    ops["partial WindowGroupLimit"] = len(re.findall(r"WindowGroupLimit \[[^\]]*\], \[[^\]]*\], \w+\(\), \d+, Partial", plan))
    scans = sorted(set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan)))
    return {"ops": {k: v for k, v in ops.items() if v}, "scan_columns": scans}


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    keys = [a for a in args if not os.path.isdir(a)] or HEADLINE
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    registry = all_queries()
    for key in keys:
        df = registry[key](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"## {key}")
        print("operators:", ", ".join(f"{k}={v}" for k, v in s["ops"].items()))
        for cols in s["scan_columns"]:
            short = ", ".join(c.strip().split("#")[0] for c in cols.split(","))
            print(f"  scan reads: {short}")
        print()


if __name__ == "__main__":
    main()
