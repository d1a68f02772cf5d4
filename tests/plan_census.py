"""Census of the physical plans of every registered query -> PLANS.md.

Usage:  python -m tests.plan_census [sf_dir] > PLANS.md

For each query: shuffles (hash / range / round-robin / single-partition
exchanges), broadcasts, join strategies, Python operators, and every parquet
scan with the number of columns read and its pushed / partition filters.
Streaming queries return the batch read of their sink, so their census shows
that read (the stream itself is a map-only or bounded-state plan).
"""

from __future__ import annotations

import re
import sys


def census(plan: str) -> dict[str, object]:
    scans = []
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\][^\n]*", plan):
        line = m.group(0)
        cols = [c for c in m.group(1).split(",") if c.strip()]
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        parts = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
        scans.append(
            {
                "columns": len(cols),
                "pushed": bool(pushed and pushed.group(1).strip()),
                "partition_pruned": bool(parts and parts.group(1).strip()),
            }
        )
    return {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "round_robin": len(re.findall(r"Exchange RoundRobinPartitioning", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))),
        "python": sorted(set(re.findall(r"(BatchEvalPython|ArrowEvalPython|MapInArrow|MapInPandas|FlatMapGroupsInArrow|FlatMapGroupsInPandas)", plan))),
        "top_k": "TakeOrderedAndProject" in plan,
        "scans": scans,
    }


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from __spark_entry__ import queries

    from clinsignal.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session()
    print("# Plan census\n")
    print(f"Executed physical plans of every registered query at `{sf_dir}` (local, AQE initial plans).")
    print("Round-robin exchanges come from spreading single-row-group test inputs over the cores; a large")
    print("table scans as many splits and skips them. Scans: columns in the read schema (date partition columns")
    print("included; they are not read from files) / pushed filters / partition pruning. Work a query did while")
    print("it was built (checkpointed per-key tables, model fits, stream runs) is not in its final plan.\n")
    print("| query | hash | range | round-robin | single | broadcast | joins | python | top-k | scans |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        c = census(df._jdf.queryExecution().executedPlan().toString())
        scans = "; ".join(
            f"{s['columns']} cols" + (" +pushed" if s["pushed"] else "") + (" +pruned" if s["partition_pruned"] else "")
            for s in c["scans"]
        )
        print(
            f"| `{name}` | {c['hash_shuffles']} | {c['range_shuffles']} | {c['round_robin']} | {c['single_partition']} | "
            f"{c['broadcasts']} | {', '.join(c['joins'])} | {', '.join(c['python'])} | {'yes' if c['top_k'] else ''} | {scans} |"
        )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
