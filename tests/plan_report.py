"""Write PLANS.md: physical-plan facts of every registered query on the
published tables of one scale factor (shuffles, join kinds, subqueries,
filters reaching the scan). Usage: python tests/plan_report.py [sf_dir]."""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waitlens.registry import PLANS, TEST, Context  # noqa: E402
from waitlens.session import get_session  # noqa: E402
from waitlens.sources.catalog import Tables, publish  # noqa: E402


def facts(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", plan)),
        "broadcast joins": plan.count("BroadcastHashJoin"),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "scalar subqueries": len(set(re.findall(r"Subquery subquery#(\d+)", plan))),
        "windows": plan.count("Window ["),
        "group limits": plan.count("WindowGroupLimit"),
        "partition filters": len(re.findall(r"PartitionFilters: \[[^\]]+\]", plan)),
        "pushed filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    path = tempfile.mkdtemp(prefix="waitlens-plans-", dir=os.environ.get("WAITLENS_SCRATCH", "/tmp"))
    publish(Tables.from_driver(spark, sf_dir, staging=path + "/staging"), path + "/tables")
    ctx = Context(Tables.from_dir(spark, path + "/tables"), TEST, path + "/published")
    ctx.materialize(path + "/facts")  # the plans that the bench times
    rows = []
    for name, plan in PLANS.items():
        df = plan(ctx)
        text = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, facts(text)))
    cols = list(rows[0][1])
    out = ["# Physical plans of the registered queries", "",
           f"Initial adaptive plans on the published tables and written shared facts of `{sf_dir}` (AQE may still turn a sort-merge join "
           "into a broadcast join at run time). Generated by `tests/plan_report.py`. No plan contains a cross join, "
           "a nested-loop join or Python code (`tests/test_plans.py`). A scalar subquery is printed, and its exchanges and pushed filters "
           "counted, wherever the initial plan refers to it; it runs once (reused).", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    out += [f"| {n} | " + " | ".join(str(f[c]) for c in cols) + " |" for n, f in rows]
    sample = PLANS["np_rate"](ctx)
    out += ["", "## Example: `np_rate`", "", "```", sample._jdf.queryExecution().executedPlan().toString()[:6000], "```"]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
