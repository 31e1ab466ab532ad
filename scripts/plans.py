"""Write PLANS.md: the operator skeleton of every batch query's physical plan
(exchanges, joins, aggregates, windows, scans with pushed filters), so the
plan-level scale properties can be reviewed without running anything.

    python scripts/plans.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.plans.catalog import QUERIES  # noqa: E402
from eventide.session import build_session  # noqa: E402

KEEP = re.compile(r"(Exchange|BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|HashAggregate|"
                  r"SortAggregate|ObjectHashAggregate|WindowGroupLimit|Window |Generate|Scan parquet|"
                  r"InMemoryRelation|Expand|Union)")


def skeleton(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: [^,]*, ", "", line)
        line = re.sub(r"functions=\[(.{0,80})[^\]]*\]", r"functions=[\1…]", line)
        line = re.sub(r"windowspecdefinition\([^)]*\)", "w(…)", line)
        line = re.sub(r"(Window \[).{100,}?(\], \[)", r"\1…\2", line)
        out.append(line[:190])
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    lines = ["# Physical plans of the batch queries", "",
             f"Generated by `scripts/plans.py` on {os.path.basename(sf)} before execution "
             "(adaptive execution may still coalesce partitions or turn a measured-small "
             "join side into a broadcast at run time). Only exchanges, joins, aggregates, "
             "windows, generators and scans are shown.", ""]
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        lines += [f"## {name}", "", "```"] + skeleton(plan) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(lines))


if __name__ == "__main__":
    main()
