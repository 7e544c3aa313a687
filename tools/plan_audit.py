"""Physical-plan audit of every registered key.

For each key the query is executed and its final adaptive plan inspected:
shuffles (Exchange hashpartitioning / rangepartitioning), broadcast and
sort-merge joins, windows, single-partition exchanges, nested-loop or
cartesian joins, and scans (columns read, pushed filters).  Run twice: with
the session defaults, and with broadcasts disabled to mimic dimensions too
large to broadcast at 100 TB (AQE then keeps shuffle joins).

usage: python tools/plan_audit.py [sf_dir] > PLAN_AUDIT.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quire.plans import load_all  # noqa: E402
from quire.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()                       # executes this Dataset's own adaptive plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a finished adaptive plan prints its final and its initial plan: keep
    # the final one only
    return plan.split("== Initial Plan ==")[0]


def audit(plan: str) -> dict:
    return {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "skew_split": len(re.findall(r"skew=true", plan)),
        "window": len(re.findall(r"\bWindow\b", plan)),
        "nested_loop_or_cartesian": len(re.findall(r"BroadcastNestedLoopJoin|CartesianProduct", plan)),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
        "scans": len(re.findall(r"FileScan", plan)),
        "pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", "plan-audit", shuffle_partitions=16)
    reg = load_all()
    cols = ["hash_shuffles", "range_shuffles", "single_partition", "bhj", "smj", "skew_split",
            "window", "nested_loop_or_cartesian", "python", "scans", "pushed_filters"]
    print(f"# Plan audit ({sf_dir})\n")
    print("Final adaptive plans of every registered key. `default` = session defaults "
          "(AQE broadcasts small sides); `no-broadcast` = autoBroadcastJoinThreshold=-1, "
          "as when dimensions are too large to broadcast. Counts are per plan "
          "(subqueries and jobs run while building a key — ids, max id, file "
          "round trips — are not included). Generated by `tools/plan_audit.py`.\n")
    for mode in ("default", "no-broadcast"):
        if mode == "no-broadcast":
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        print(f"\n## {mode}\n")
        print("| key | " + " | ".join(cols) + " |")
        print("| --- | " + " | ".join("---" for _ in cols) + " |")
        for name, q in reg.items():
            try:
                a = audit(final_plan(q.build(spark, sf_dir)))
                print(f"| {name} | " + " | ".join(str(a[c]) for c in cols) + " |", flush=True)
            except Exception as e:  # keep auditing the others
                print(f"| {name} | error: {type(e).__name__} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
