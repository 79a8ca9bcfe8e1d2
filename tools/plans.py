"""Write PLANS.md: the physical plan of every registered query's result.

Usage: python tools/plans.py [data_dir] > PLANS.md
For iterative queries the plan is that of the returned DataFrame (the last
assignment or the history), the loop's per-pass jobs are described in
kestrel/operators/lloyd.py.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kestrel.plans import ORACLES, QUERIES  # noqa: E402
from kestrel.session import get_session  # noqa: E402


def main():
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8,
                        conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# PLANS\n")
    print(f"Physical plans (before AQE re-planning) of the registered queries on `{data_dir}`.")
    print("Generated by `tools/plans.py`.\n")
    for key in sorted(QUERIES):
        df = QUERIES[key](spark, data_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        tag = "oracle" if key in ORACLES else "rows-only"
        print(f"## {key} ({tag})\n\n```\n{plan.rstrip()}\n```\n")
    _lloyd_pass_plan(spark, data_dir)


def _lloyd_pass_plan(spark, data_dir):
    """One Lloyd pass (distributed-merge form): scan of the persisted points,
    scoring in mapInArrow, partial rows merged by a groupBy."""
    from kestrel.operators import lloyd as L
    from kestrel.sources.tables import load_table

    pts, *_ = L.prepare_points(load_table(spark, data_dir, "embeddings"), "embedding", "vec_id")
    cents = L.init_centroids(pts, 4, "lowest")
    plan = L.pass_frame(pts, cents, cents)._jdf.queryExecution().executedPlan().toString()
    print("## one Lloyd pass (distributed-merge form, current and previous centroids)\n")
    print(f"```\n{plan.rstrip()}\n```\n")


if __name__ == "__main__":
    main()
