"""Explain every registered query and summarise its physical plan.

usage: python tools/plan_report.py [--sf DIR] [--markdown] [name ...]
Counts exchanges and join strategies, and flags operators that do not scale:
nested-loop or Cartesian joins, Python UDF evaluation, single-partition exchanges.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FLAGS = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
         "FlatMapGroupsInPandas"]


def single_partition_inputs(text: str) -> list[str]:
    """What feeds each single-partition exchange: a partial aggregate (one row per task) is fine."""
    lines = text.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            child = lines[i + 1].strip(" :+-*()0123456789")
            out.append("partial-agg" if "partial_" in child else child.split("(")[0].split(" ")[0])
    return out


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarise(text: str) -> dict:
    scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", text)
    return {
        "exchanges": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|"
                                    r"Exchange RoundRobinPartitioning", text)),
        "broadcasts": text.count("BroadcastExchange"),
        "bhj": text.count("BroadcastHashJoin"),
        "smj": text.count("SortMergeJoin"),
        "hash_aggs": text.count("HashAggregate"),
        "sort_aggs": text.count("SortAggregate"),
        "windows": len(re.findall(r"\bWindow\b", text)),
        "scan_cols": [len(s.split(",")) for s in scans],
        "flags": [f for f in FLAGS if f in text],
        "single_partition": single_partition_inputs(text),
    }


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--markdown", action="store_true")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from martforge.plans.queries import REGISTRY
    from martforge.session import get_session

    spark = get_session("local[4]", shuffle_partitions=8)
    names = args.names or sorted(REGISTRY)
    if args.markdown:
        print("| query | exchanges | broadcast / BHJ / SMJ | hash / sort aggs | windows | scan columns | "
              "single-partition inputs | flags |")
        print("|---|---|---|---|---|---|---|---|")
    for name in names:
        s = summarise(plan_text(REGISTRY[name](spark, args.sf)))
        if args.markdown:
            print(f"| {name} | {s['exchanges']} | {s['broadcasts']} / {s['bhj']} / {s['smj']} | "
                  f"{s['hash_aggs']} / {s['sort_aggs']} | {s['windows']} | {s['scan_cols']} | "
                  f"{', '.join(s['single_partition']) or '-'} | {', '.join(s['flags']) or '-'} |")
        else:
            print(name, s)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
