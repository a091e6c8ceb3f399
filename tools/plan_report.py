"""Summarise the physical plan of every registered query as a Markdown table.

usage: python tools/plan_report.py SF_DIR [DERIVED_DIR] > PLANS.md
With DERIVED_DIR (from sources.tables.materialize) the payments tables are
read as stored Parquet, so date bounds can be seen reaching the scans.
Plans are AQE initial plans: join strategies can still change at runtime
(e.g. a sort-merge join becoming a broadcast join once sizes are known).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens import catalog  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.tables import Tables  # noqa: E402

KINDS = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct"]


def main():
    sf_dir = sys.argv[1]
    derived = sys.argv[2] if len(sys.argv) > 2 else None
    spark = build_session("local[8]")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # full PushedFilters lists
    t = Tables(spark, sf_dir, derived_dir=derived)
    print("| query | SMJ | BHJ | nested loop / cartesian | shuffles | broadcasts | windows "
          "| tables scanned | tables with a pushed time bound |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in catalog.plans().items():
        plan = fn(t)._jdf.queryExecution().executedPlan().toString()
        n = {k: len(re.findall(rf"\b{k}\b", plan)) for k in KINDS}
        shuffles = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") \
            + plan.count("Exchange RoundRobinPartitioning")
        tables, timed = set(), set()
        for line in plan.splitlines():
            m = re.search(r"FileScan parquet .*\[file:([^\]]*)\]", line)
            if not m:
                continue
            table = m.group(1).rstrip("/").split("/")[-1].replace(".parquet", "")
            tables.add(table)
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)
            if pushed and re.search(r"\((created|incurred_at|date|o_orderdate|l_shipdate|"
                                    r"available_on),", pushed.group(1)):
                timed.add(table)
        print(f"| {name} | {n['SortMergeJoin']} | {n['BroadcastHashJoin']} | "
              f"{n['BroadcastNestedLoopJoin'] + n['CartesianProduct']} | {shuffles} | "
              f"{plan.count('BroadcastExchange')} | {plan.count('Window ')} | {len(tables)} | "
              f"{len(timed)} |")
    spark.stop()


if __name__ == "__main__":
    main()
