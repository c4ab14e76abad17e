"""Write PLANS.md: the operators that decide scale behaviour in each headline query's
physical plan (exchanges, aggregates, joins, window limits, Python stages, scans).

    python tools/plan_shapes.py [--sf /root/testdata/sf0.1] [--out PLANS.md]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["Exchange", "Aggregate", "Join", "TakeOrdered", "WindowGroupLimit", "Window ", "MapIn",
        "Generate", "Subquery", "FileScan", "Union"]


def shape(plan: str) -> list[str]:
    out = []
    for line in plan.split("\n"):
        if any(k in line for k in KEYS):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r"\[plan_id=\d+\]", "", line)
            if "FileScan" in line:
                m = re.search(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: (\[[^\]]*\])", line)
                line = line[:line.index("FileScan")] + (f"FileScan parquet [{m.group(1)}] PushedFilters: {m.group(2)}"
                                                         if m else "FileScan parquet")
            out.append(line.rstrip()[:150])
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"))
    args = ap.parse_args()
    from bench import HEADLINE
    from snapfeed.plans import catalog
    from snapfeed.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    lines = ["# Physical plan shapes of the headline queries", "",
             f"Generated by `tools/plan_shapes.py` at {os.path.basename(args.sf)} (local[8], AQE initial plan).",
             "Only the operators that decide scale behaviour are kept. Identical exchanges that appear",
             "under several branches (e.g. the first-seen shuffle under both fronts of `article_feed`)",
             "run once: the final adaptive plan shows them as `ReusedExchange`.", ""]
    for name in HEADLINE:
        plan = qs[name](spark, args.sf)._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + shape(plan) + ["```", ""]
    with open(args.out, "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
