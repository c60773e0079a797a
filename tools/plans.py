"""Write PLANS.md: the physical plan shape of every registered query.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.1)

The tree keeps operator names plus the facts that matter for scale: join
strategy, exchange partitioning, pushed filters, partition filters and
pruned read schemas.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiforge.plans.catalog import QUERIES  # noqa: E402
from kpiforge.session import get_spark  # noqa: E402

JOIN = re.compile(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)"
                  r"(?: \[([^\]]*)\], \[[^\]]*\],)? ?(\w+)?")
KEEP = re.compile(r"(Exchange \w+|HashAggregate|SortAggregate|"
                  r"ObjectHashAggregate|TakeOrderedAndProject|Window|Expand|Generate|Union|Filter|"
                  r"FileScan parquet|Scan parquet|BroadcastExchange|Sort |Subquery|Range|ReusedExchange|"
                  r"AQEShuffleRead \w+)")


def compact(plan: str) -> list[str]:
    final = plan.split("+- == Initial Plan ==")[0]
    out = []
    for line in final.splitlines():
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        j = JOIN.search(line)
        if j:
            keys = re.sub(r"#[0-9]+L?", "", j.group(2) or "")
            out.append(" " * indent + f"{j.group(1)} {j.group(3) or ''} on [{keys}]".rstrip())
            continue
        m = KEEP.search(line)
        if not m:
            continue
        text = m.group(0).strip()
        if "Scan parquet" in text or "FileScan" in text:
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            pf = re.search(r"PartitionFilters: (\[[^\]]*\])", line)
            text = "Scan parquet"
            if cols:
                names = [re.sub(r"#[0-9]+L?", "", c) for c in cols.group(1).split(",") if c]
                text += f" cols={len(names)} [{', '.join(names)}]"
            if pf and pf.group(1) != "[]":
                text += f" PartitionFilters={re.sub(r'#[0-9]+L?', '', pf.group(1))}"
        if text.startswith("Exchange"):
            p = re.search(r"Exchange (\w+)\(([^)]*)\)", line)
            if p:
                text = f"Exchange {p.group(1)}({re.sub(r'#[0-9]+L?', '', p.group(2))})"
        out.append(" " * indent + text)
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false",
                                                                        "spark.driver.memory": "8g",
                                                                        # as at scale: no side is small
                                                                        "spark.sql.autoBroadcastJoinThreshold": "-1"})
    lines = ["# Physical plans", "",
             f"Generated by `python tools/plans.py {sf_dir}` on local[8]: the static physical plan",
             "of every registered query (AQE re-optimises it at run time from measured sizes).",
             "Operator skeleton only: join strategy and keys, exchanges with their partitioning,",
             "aggregates, scans with pushed partition filters and the number of columns read.",
             "Broadcast joins are off, as at a scale where no side is small.", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + compact(plan) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
