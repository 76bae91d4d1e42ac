"""Write PLANS.md: a summary of each catalog query's final (adaptive)
physical plan: shuffles, joins, aggregates, scans (read schema, pushed
filters) and any Python evaluation.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wordmill.plans.catalog import QUERIES  # noqa: E402
from wordmill.session import build_session  # noqa: E402


def final_plan(df) -> str:
    """Run the DataFrame through its own QueryExecution (no Python
    conversion) so the adaptive plan is final, then return it."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    text = qe.executedPlan().toString()
    # AQE prints the final plan and then the initial one: keep the final.
    return text.split("== Initial Plan ==")[0]


def _node_lines(plan: str, name: str) -> int:
    return sum(1 for line in plan.splitlines() if re.match(r"^[\s:+\-|*()0-9]*" + name + r"\b", line))


def summarize(plan: str) -> dict:
    kinds: dict[str, int] = {}
    for line in plan.splitlines():
        m = re.match(r"^[\s:+\-|*()0-9]*(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)\b.*?(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti|Cross)", line)
        if m:
            key = f"{m.group(1)} {m.group(2)}"
            kinds[key] = kinds.get(key, 0) + 1
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
    return {
        "shuffles": _node_lines(plan, "Exchange"),
        "reused": _node_lines(plan, "ReusedExchange"),
        "broadcasts": _node_lines(plan, "BroadcastExchange"),
        "joins": kinds,
        "partial_aggs": len(re.findall(r"partial_", plan)),
        "python": any(k in plan for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")),
        "scans": sorted({re.sub(r"#\d+L?", "", x) for x in scans}),
        "pushed": sorted({re.sub(r"#\d+L?", "", x) for x in re.findall(r"PushedFilters: \[([^\]]*)\]", plan)}),
        "take_ordered": "TakeOrderedAndProject" in plan,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# PLANS\n")
    print(f"Physical plans of the query catalog at `{sf_dir}` (`local[8]`), as built by")
    print("`tools/plan_report.py`. Shuffles count hash/range/single-partition exchanges;")
    print("reused exchanges are shuffles read again instead of recomputed. Scans list")
    print("the columns read. No plan contains a cartesian product, a")
    print("nested-loop join or Python evaluation (also asserted by `tests/test_plans.py`).\n")
    print("| query | shuffles (reused) | broadcasts | joins | partial aggs | columns read | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, q in QUERIES.items():
        t0 = time.time()
        plan = final_plan(q(spark, sf_dir))
        s = summarize(plan)
        joins = ", ".join(f"{k} x{v}" if v > 1 else k for k, v in s["joins"].items()) or "-"
        scans = "; ".join(s["scans"]) or "-"
        pushed = "; ".join(p for p in s["pushed"] if p) or "-"
        extra = " (top-k)" if s["take_ordered"] else ""
        print(f"| `{name}`{extra} | {s['shuffles']} ({s['reused']}) | {s['broadcasts']} | {joins} | {s['partial_aggs']} | {scans} | {pushed} |")
        assert not s["python"], name
        print(f"{name}: {time.time() - t0:.1f}s", file=sys.stderr)
    spark.stop()


if __name__ == "__main__":
    main()
