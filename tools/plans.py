"""Print the plan shape of the bounded queries as a Markdown table.

usage: python tools/plans.py [--sf DIR] > PLANS.md

Automatic broadcasts are off, so joins show as they would between large
tables.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.catalog import QUERIES, streams  # noqa: E402
from millrace.session import local_session  # noqa: E402

COUNTED = {
    "scans": r"FileScan",
    "hash exchanges": r"Exchange hashpartitioning",
    "range exchanges": r"Exchange rangepartitioning",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "window limits": r"WindowGroupLimit.*Partial",
    "nested loops": r"NestedLoopJoin|CartesianProduct",
    "Python": r"EvalPython|InPandas|PythonUDF",
}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    streaming = {n for n, q in QUERIES.items() if q.__module__ == streams.__name__}
    print("# Plan shapes\n\nPrinted by `python tools/plans.py`: node counts of each bounded query's plan with automatic")
    print("broadcasts off, before adaptive execution. The joins that shape the given tables are included. So is every")
    print("mention of a subquery or shared exchange, which run once. Queries that write tables show the final read.\n")
    print("| query | " + " | ".join(COUNTED) + " |")
    print("| --- |" + " ---: |" * len(COUNTED))
    for name, query in sorted(QUERIES.items()):
        if name in streaming or name == "train_revenue_model":
            continue
        text = query(spark, args.sf)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(pattern, text)) for pattern in COUNTED.values()]
        print(f"| {name} | " + " | ".join(str(count or "") for count in counts) + " |", flush=True)


if __name__ == "__main__":
    main()
