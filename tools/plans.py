"""Summarise the physical plans of registered queries (no execution beyond stored inputs).

usage: python tools/plans.py [sf_dir] [key ...]   -> markdown table on stdout
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from cohortsmith import build_session  # noqa: E402
from cohortsmith.plans import registry  # noqa: E402

def summary(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    return {
        "shuffle exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "hash joins (broadcast)": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "nested-loop joins": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "partial aggregates": sum(1 for line in plan.splitlines() if "Aggregate(" in line and "partial_" in line),
        "parquet scans": len(scans),
        "scans with pushed filters": sum(1 for s in scans if "PushedFilters: []" not in s),
        "python UDF nodes": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)),
    }


def build_plans(spark, sf: str) -> list[tuple[str, object]]:
    """The plans that *produce* the stored tables (unstored), then the analysis queries."""
    b = registry.build_for(spark, sf)
    lazy = b.with_spine(b.spine)  # same spine, given explicitly: feature tables stay lazy
    return [
        ("coded_observations (write)", b.coded_observations_plan),
        ("coded_prescriptions (write)", b.coded_prescriptions_plan),
        ("clean_measurements (write)", b.clean_plan),
        ("baseline_nearest", b.baseline_long),
        ("biomarkers (write)", lazy.biomarkers),
        ("comorbidities (write)", lazy.comorbidities),
        ("medications (write)", lazy.medications),
        ("efi (write)", lazy.efi),
        ("cross_section_efi (write)", b.cross_section_plan(True)),
        ("table_one_continuous", registry.QUERIES["table_one_continuous"](spark, sf)),
        ("hosp_prefix_join", registry.QUERIES["hosp_prefix_join"](spark, sf)),
    ]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:]
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    items = ([(k, registry.QUERIES[k](spark, sf)) for k in keys] if keys else build_plans(spark, sf))
    rows = [(k, summary(df._jdf.queryExecution().executedPlan().toString())) for k, df in items]
    cols = list(rows[0][1])
    print("| plan | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for k, s in rows:
        print(f"| {k} | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
