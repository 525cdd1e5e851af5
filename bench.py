"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. A query is executed in
full with the ``noop`` sink (every row produced, nothing collected to the
driver); the time is the best of ``$BENCH_REPEAT`` runs (default 2).

``build_log`` is the one-off cost of storing the click log (the
three-table view written once per session); it is part of the total.
The slow model queries run once. Names on the command line choose others.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickmart.plans.catalog import all_queries  # noqa: E402
from clickmart.session import build_session  # noqa: E402
from clickmart.sources import fixtures  # noqa: E402

HEADLINE = [
    "top_items",
    "top_items_all",
    "top_merchants",
    "top_merchants_all",
    "sorted_item_counts",
    "age_counts_raw",
    "age_share",
    "gender_share",
    "sql_age_share",
    "sql_gender_share",
    "action_features",
    "pair_features",
    "features_filled",
    "scoring_features",
    "libsvm_lines",
    "train_lr",
    "train_gbt",
    "train_svm",
    "train_svm_norm",
    "evaluate_all",
    "train_save_all",
    "submission",
    "item_ranks",
    "tree_routes",
    "tree_grown",
    "score_areas",
]

ONCE = {"train_svm", "train_svm_norm", "evaluate_all", "train_save_all", "submission"}


def run(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        app_name="clickmart-bench",
        shuffle_partitions=max(8, cpus * 2),
        extra={
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='clickmart-bench-')}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = all_queries()
    # warm the JVM on the smallest table set, untimed
    small = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(small):
        run(spark, qs["count_by_item"], small)
    times = {}
    t0 = time.perf_counter()
    fixtures.log_table(spark, sf_dir, refresh=True)
    times["build_log"] = round(time.perf_counter() - t0, 3)
    for name in names:
        times[name] = round(min(run(spark, qs[name], sf_dir) for _ in range(1 if name in ONCE else repeat)), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
