"""Summarise the executed physical plan of every relational catalogue query.

For each query: exchanges by kind, broadcast / sort-merge / nested-loop joins,
window operators, Python passes, and the parquet scans' pushed filters and read
schemas.  Run after a change to see that filters reach the scan, that no
un-keyed window or nested-loop join touches row-level data, and how many shuffles
a plan costs.  Writes markdown to stdout.
"""

from __future__ import annotations

import re
import sys


def final_plan(plan: str) -> str:
    """The final tree of an adaptive plan (which prints final and initial trees; nested
    subqueries carry their own, indented markers)."""
    def depth(ln: str) -> int:
        return len(ln) - len(ln.lstrip(" :|"))

    out, skip_below = [], None
    for ln in plan.splitlines():
        d = depth(ln)
        if skip_below is not None:
            if d > skip_below:
                continue
            skip_below = None
        if ln.lstrip(" :|").startswith("+- == Initial Plan =="):
            skip_below = d
            continue
        out.append(ln)
    return "\n".join(out)


def summarize(plan: str) -> dict:
    plan = final_plan(plan)
    reused = [ln for ln in plan.splitlines() if "ReusedExchange" in ln]
    own = "\n".join(ln for ln in plan.splitlines() if "ReusedExchange" not in ln)
    return {
        "hash_exch": len(re.findall(r"Exchange hashpartitioning", own)),
        "range_exch": len(re.findall(r"Exchange rangepartitioning", own)),
        "single_exch": len(re.findall(r"Exchange SinglePartition", own)),
        "reused": len(reused),
        "bcast_join": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "python": plan.count("MapInPandas") + plan.count("MapInArrow") + plan.count("ArrowEvalPython"),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""}),
    }


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from sparkdeck.plans.catalog import REGISTRY
    from sparkdeck.session import get_session
    import os
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    only = set(sys.argv[2:])
    extra = {}
    spark = get_session("local[8]", shuffle_partitions=16, extra=extra)
    print("| query | hash exch | range exch | single-partition exch | reused exch | broadcast joins "
          "| sort-merge joins | nested-loop joins | windows | Python passes | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, (fn, _) in REGISTRY.items():
        if only and name not in only:
            continue
        df = fn(spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()                       # run this very plan, so AQE's final plan is printed
        plan = qe.executedPlan().toString()
        s = summarize(plan)
        pushed = "; ".join(p[:80] for p in s["pushed"]) or "—"
        print(f"| `{name}` | {s['hash_exch']} | {s['range_exch']} | {s['single_exch']} | {s['reused']} | "
              f"{s['bcast_join']} | "
              f"{s['smj']} | {s['bnlj']} | {s['window']} | {s['python']} | {pushed} |", flush=True)
