"""Benchmark: wall seconds of the headline queries on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    python bench.py --all          # every registered query
    python bench.py KEY [KEY ...]  # selected queries

Each query is executed in full with a ``noop`` write (every row is produced, nothing
is collected to the driver). An untimed warm-up query (a scan and aggregation of
``region``) absorbs JVM start-up. Every key runs ``BENCH_REPEATS`` times (default 1) and its
median counts. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from kestrel.plans import catalog  # noqa: E402
from kestrel.session import build_session  # noqa: E402

HEADLINE = [
    "top_products",            # Q1, the flagship (Task 1)
    "top_products_events",
    "join_fanout_dedupe",
    "top_products_per_day",
    "fixed_width_report",
    "json_lines_scan",
    "distinct_rows",
    "clean_text",              # Task 2 preprocessing
    "tfidf_smooth_l2",
    "auc_score",
    "model_comparison",
    "exact_split",
    "regression_job",          # Q3
    "learning_curve",
    "silhouette",
    "sentiment_pipeline",      # Q2 (Task 2 end to end)
    "overfit_job",             # Q4
    "clustering_job",          # Q5
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    args = sys.argv[1:]
    run_all = "--all" in args
    only = [a for a in args if not a.startswith("--")]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, scan_partitions=cpus,
                          app_name="kestrel-bench")
    catalog.load_all()
    region = spark.read.parquet(f"{sf_dir.rstrip('/')}/region.parquet")
    region.groupBy("r_regionkey").count().write.format("noop").mode("overwrite").save()
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "1")))
    timings: dict[str, float] = {}
    for key in only or (sorted(catalog.QUERIES) if run_all else HEADLINE):
        took = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(took), 3)
        print(f"# {key}: {timings[key]:.2f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_wall_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
