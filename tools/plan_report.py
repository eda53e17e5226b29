"""Summarise the executed physical plan of every registered query into PLANS.md.

usage: python tools/plan_report.py [sf_dir]   (runs each query once into the noop sink)
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.plans.registry import load_all  # noqa: E402
from lakemart.session import get_session  # noqa: E402


def _single_under(plan: str) -> tuple[int, int]:
    """SinglePartition exchanges split by their parent: a final aggregate
    (merges one partial row per task: harmless) vs anything else (a window or
    sort that would pull all rows into one task)."""
    lines = plan.splitlines()
    agg = other = 0
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" not in ln:
            continue
        depth = len(ln) - len(ln.lstrip(" :|+-"))
        parent = next((lines[j] for j in range(i - 1, -1, -1)
                       if len(lines[j]) - len(lines[j].lstrip(" :|+-")) < depth), "")
        if "Aggregate" in parent:
            agg += 1
        else:
            other += 1
    return agg, other


def summarise(plan: str) -> dict:
    agg1, other1 = _single_under(plan)
    return {
        "single_agg": agg1, "single_other": other1,
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "bnlj": plan.count("BroadcastNestedLoopJoin"),
        "window": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython", plan)),
        "scans": plan.count("FileScan parquet") + plan.count("Scan ExistingRDD"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", app="lakemart-plans", shuffle_partitions=8)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakemart-plan-ckpt-"))
    rows = []
    for name, e in load_all().items():
        df = e.fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarise(plan)))
    cols = ["exchanges", "single_agg", "single_other", "bhj", "smj", "bnlj", "window", "python", "scans", "pushed"]
    out = ["# Physical plans (final AQE plans at " + os.path.basename(sf) + ")", "",
           "Generated by `tools/plan_report.py`. `single_agg` = `Exchange SinglePartition` under a final aggregate "
           "(merges one partial row per task); `single_other` = any other single-partition exchange (the "
           "windows over one row per calendar month, and over one row per partition in the row numbering; see README); `bhj`/`smj`/`bnlj` = "
           "broadcast-hash / sort-merge / broadcast-nested-loop joins (AQE picks broadcast only after measuring a side, "
           "so small test tables broadcast where 100 TB would sort-merge); `window` = Window operators; `python` = "
           "Arrow Python stages; `scans` include checkpointed inputs; `pushed` = scans with pushed-down filters.", "",
           "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for name, s in rows:
        out.append(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
