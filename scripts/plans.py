"""Summarise the physical plan of every registered query (PLANS.md).

For each query: shuffle exchanges, broadcast exchanges, join strategies, window group limits, and whether the
parquet scans carry pushed filters.  Plans are taken on sf0.001 with landed analogs (parquet tables).
usage: python scripts/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trestle.plans.registry import load_all  # noqa: E402
from trestle.session import build_session  # noqa: E402
from trestle.sources.tables import Tables  # noqa: E402


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    joins = {}
    for ln in lines:
        m = re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                      r"[^,]*?(Inner|LeftOuter|LeftAnti|LeftSemi|Cross|RightOuter|FullOuter)?", ln)
        if m:
            joins[m.group(1)] = joins.get(m.group(1), 0) + 1
    scans = [ln for ln in lines if "FileScan parquet" in ln]
    pushed = sum(1 for s in scans if "PushedFilters: [" in s and "PushedFilters: []" not in s)
    return {
        "shuffles": sum(1 for ln in lines if "Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln),
        "single": sum(1 for ln in lines if "Exchange SinglePartition" in ln),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "joins": ", ".join(f"{k} x{v}" for k, v in sorted(joins.items())) or "-",
        "group_limit": "yes" if "WindowGroupLimit" in plan else "-",
        "scans": f"{pushed}/{len(scans)}",
        "python": "yes" if "EvalPython" in plan else "no",
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[4]", shuffle_partitions=8)
    t = Tables(spark, sf_dir)
    print("# PLANS\n")
    print("Physical plans of the registered queries (initial AQE plan, before runtime re-optimisation), taken by")
    print("`scripts/plans.py` on landed analogs. `shuffles` counts hash/range exchanges, `single` counts")
    print("single-partition exchanges (global top-1 merges and one-row aggregates), `scans` is scans with pushed")
    print("filters / all parquet scans. AQE may still turn a sort-merge join into a broadcast join at run time.\n")
    print("| query | shuffles | single | broadcasts | joins | group limit | scans pushed | python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for key, fn in load_all().items():
        plan = fn(t)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{key}` | {s['shuffles']} | {s['single']} | {s['broadcasts']} | {s['joins']} | {s['group_limit']} "
              f"| {s['scans']} | {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main()
