"""Write PLANS.md: per registered query, what the physical plan does.

Counts shuffles (Exchange), join strategies, scans with pushed filters,
whole-stage-codegen stages and Python nodes, from the static physical plan
(AQE off for the report only: same shuffles, and the codegen stages are
visible; joins that AQE turns into broadcasts at run time show as sort-merge).

    python plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigiframe.plans.catalog import QUERIES  # noqa: E402
from vigiframe.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
    "broadcast joins": r"BroadcastHashJoin",
    "sort-merge joins": r"SortMergeJoin",
    "nested-loop/cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow \[",
    "python nodes": r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(extra={"spark.sql.adaptive.enabled": "false"})
    print("# PLANS\n")
    print(f"Static physical plans of the registered queries at `{sf_dir}` (generated by `plan_report.py`;")
    print("AQE is off for the report, so run-time broadcast conversions of derived dimensions are not shown).")
    print("Columns count plan nodes; `pushed` lists the filters handed to the Parquet reader.\n")
    print("| query | shuffles | bcast joins | smj | nested loop | windows | python | codegen stages | pushed |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for key in sorted(QUERIES):
        qe = QUERIES[key](spark, sf_dir)._jdf.queryExecution()
        plan = qe.executedPlan().toString()
        n = {name: len(re.findall(p, plan)) for name, p in PATTERNS.items()}
        stages = len(set(re.findall(r"\*\((\d+)\)", qe.executedPlan().treeString())))
        pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan)
                         if p and p.strip() and not re.fullmatch(r"(IsNotNull\([^)]*\)(, )?)+", p)})
        print(f"| {key} | {n['shuffles']} | {n['broadcast joins']} | {n['sort-merge joins']} | "
              f"{n['nested-loop/cartesian']} | {n['windows']} | {n['python nodes']} | {stages} | "
              f"{'; '.join(pushed)[:120]} |")
    spark.stop()


if __name__ == "__main__":
    main()
