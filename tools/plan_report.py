"""Print a compact physical-plan summary of registered queries: exchanges,
join strategies, windows, scans with their pushed filters and read schema.

    python tools/plan_report.py [--sf DIR] names...
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rankfold.plans.registry import QUERIES, load_all  # noqa: E402
from rankfold.session import get_spark  # noqa: E402


def summary(plan: str) -> dict:
    ops = {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", plan)),
        "broadcast_exchanges": len(re.findall(r"BroadcastExchange", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "hash_aggs": len(re.findall(r"HashAggregate|ObjectHashAggregate", plan)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan)),
        "cartesian": len(re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
    }
    scans = sorted(set(re.findall(r"FileScan parquet \S*\[([^\]]*)\]", plan)))
    ops["scans"] = scans[:6]
    return ops


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_spark("local[8]", shuffle_partitions=16)
    load_all()
    for n in args.names or sorted(QUERIES):
        df = QUERIES[n](spark, args.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(n, summary(plan))


if __name__ == "__main__":
    main()
