"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a ``noop`` write (every row produced,
nothing collected to the driver) and timed end to end, including the jobs a
query runs while it is built (model fits, Lloyd passes, checkpoint writes).
Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kestrel.session import clear_scratch, get_session  # noqa: E402
from kestrel.plans import QUERIES  # noqa: E402

# Headline set, in this order; $BENCH_QUERIES (comma-separated) overrides it.
HEADLINE = [
    "sql_like_join", "sql_month_filter", "month_filter_distinct", "sql_sum_distinct",
    "group_sum", "group_avg_all", "project_rename", "binarize_label", "case_not_null",
    "typed_cast", "typed_cast_date", "parse_us_date", "strip_text", "text_split_scan",
    "text_arity_filter", "csv_roundtrip", "range_source", "row_index", "scan_index",
    "array_drop_last", "array_affine", "euclidean_distance", "vector_sum_by_key",
    "assemble_features", "string_index", "string_index_multi", "string_index_joined", "string_index_many",
    "nearest_centroid", "lloyd_update", "lloyd_3pass", "lloyd_moved",
    "intra_cluster_distance", "kmeans_cost", "cluster_sizes", "label_by_cluster",
    "cluster_label_pct", "cluster_label_pct_joined", "accuracy", "class_recall", "mean_stddev_pop",
    "lloyd_converge", "lloyd_restarts", "kmeans_ml", "kmeans_ml_centers",
    "kmeans_ml_report", "logreg_fit", "logreg_score", "logreg_recall", "logreg_accuracy",
    "gen_gaussian", "gen_then_cluster", "row_id", "sample_k", "sample_k_hash",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else [q for q in HEADLINE if q in QUERIES]
    spark = get_session(f"local[{cpus}]", app="kestrel-bench", shuffle_partitions=cpus,
                        conf={"spark.ui.showConsoleProgress": "false",
                              "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM warm-up, not timed

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # one broken query must not hide the others' times
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"{name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        clear_scratch(spark)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    record = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
              "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}
    if failed:
        record["failed"] = failed
    print(json.dumps(record))
    spark.stop()


if __name__ == "__main__":
    main()
