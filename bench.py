"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then three times, once only if that took long; the median counts. Results
go to the noop sink, so every row is produced and none reaches the driver. A query's figure goes to the error
stream as soon as it is there. One that goes beyond its limit is stopped and named, and after the limit of the
whole no further query is begun, so that the JSON line is always printed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.plans.catalog import all_queries  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = (
    "impute_mode impute_median impute_group_median interpolate_groups clean_by_spec winsorize one_hot scale_standard "
    "transform_table split_chronological split_stratified folds_stratified correlation_matrix chi_square mutual_information "
    "linear_regression linear_cross_validation naive_bayes knn_classification roc_auc average_precision "
    "classification_report describe rank_per_metric model_summary model_leaderboard drift_ks snapshot_metadata forest_importance forest_regression"
).split()


# Seconds: of one run, of all, and of a warm-up after which one more run is enough.
LIMIT, WHOLE, LONG = 240, 1500, 30


def run(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    all_queries()[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus)
    wanted = sys.argv[1:] or HEADLINE
    times, stopped, began = {}, [], time.perf_counter()
    for name in wanted:
        if time.perf_counter() - began > WHOLE:
            stopped.append(name)
            continue
        timer = threading.Timer(LIMIT, spark.sparkContext.cancelAllJobs)
        timer.start()
        try:
            first = run(name, spark, folder)
            times[name] = round(statistics.median(run(name, spark, folder) for _ in range(1 if first > LONG else 3)), 3)
        except Exception as problem:
            stopped.append(name)
            print(f"{name} {type(problem).__name__}", file=sys.stderr, flush=True)
            continue
        finally:
            timer.cancel()
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "stopped": stopped,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
