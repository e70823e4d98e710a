"""Count the physical operators of the event queries' executed plans.

Usage: python scripts/plan_report.py [sf_dir]  -> markdown table on stdout.
Each query is executed (collect) so the adaptive plan is the final one.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from actiflow.plans.catalog import QUERIES  # noqa: E402
from actiflow.session import get_session  # noqa: E402

PATTERNS = {
    "hash/range exchanges": r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "top-k": r"TakeOrderedAndProject",
    "python": r"MapInPandas|MapInArrow|PythonUDF",
    "reused exchanges": r"ReusedExchange",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|---|" + "---|" * len(PATTERNS))
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        text = text.split("== Initial Plan ==")[0]   # adaptive plans print both
        counts = [len(re.findall(p, text)) for p in PATTERNS.values()]
        print(f"| `{name}` | " + " | ".join(str(c) for c in counts) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
