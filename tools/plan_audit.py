"""Print, per registered query, the plan operators that deserve a second look at scale:
nested-loop / cartesian joins, single-partition exchanges, Python evaluation, and
how many shuffles (Exchange) the plan has.

usage: python tools/plan_audit.py [sf_dir] [key ...]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans import catalog  # noqa: E402
from kestrel.session import build_session  # noqa: E402

WATCH = ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition", "ArrowEvalPython",
         "BatchEvalPython", "TakeOrderedAndProject", "WindowGroupLimit", "SortAggregate")


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    catalog.load_all()
    for k in keys or sorted(catalog.QUERIES):
        df = catalog.QUERIES[k](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = {w: len(re.findall(w, plan)) for w in WATCH if w in plan}
        print(f"{k:28s} exchanges={plan.count('Exchange')} {found}")
    spark.stop()


if __name__ == "__main__":
    main()
