"""Wall time of the headline queries. Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_QUERIES, BENCH_LIMIT (seconds a query).

Each time goes to standard error as soon as it is known; standard output gets one JSON line at the end, also when the run is
stopped. A query that exceeds the limit is cancelled and has no time.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import threading
import time

from pyspark import inheritable_thread_target

from tarmac.catalog import QUERIES
from tarmac.plans.storage import drop_stages
from tarmac.session import build_session

HEADLINE = [
    "scan_project", "scan_observations", "pivot_weather_filled", "merge_weather", "merge_rolling_weather", "merge_rolling_delay",
    "flight_history", "final_train", "past_flights", "past_flights_blocks", "past_flights_filled", "cumulative_flights",
    "roll_weather_key", "roll_weather_global", "roll_delay_global", "airport_congestion", "nearest_station",
    "multi_agg", "describe", "cap_outliers", "impute_mode_median", "histogram", "box_stats", "drop_duplicates", "holiday_flag", "cyclical",
    "undersample", "undersample_all", "train_test_split", "stratified_sample", "kfold_assign", "standardize",
    "target_encode_train", "select_k_best", "pearson_matrix", "spearman_target", "welch_t", "chi_square", "kde_curve", "local_trend",
    "clf_metrics", "roc_auc", "reg_metrics", "lin_reg", "log_reg", "hgb_clf",
]


def timed(spark, name: str, sf_dir: str, limit: float) -> float | None:
    """Seconds of a query, or None if it was cancelled after ``limit``. Its stage tables are deleted in either case."""
    failed: list[BaseException] = []

    def run() -> None:
        spark.sparkContext.setJobGroup(name, name, interruptOnCancel=True)
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except BaseException as error:  # noqa: BLE001
            failed.append(error)

    start = time.perf_counter()
    worker = threading.Thread(target=inheritable_thread_target(spark)(run), daemon=True)
    worker.start()
    worker.join(limit)
    late = worker.is_alive()
    if late:
        spark.sparkContext.cancelJobGroup(name)
        spark.sparkContext.cancelAllJobs()
        worker.join(30)
    seconds = time.perf_counter() - start
    drop_stages(spark)
    if late:
        print(f"{name}: cancelled after {limit:.0f} s", file=sys.stderr, flush=True)
        return None
    if failed:
        print(f"{name}: {failed[0]!r}"[:500], file=sys.stderr, flush=True)
        return None
    print(f"{name}: {seconds:.3f} s", file=sys.stderr, flush=True)
    return round(seconds, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    limit = float(os.environ.get("BENCH_LIMIT", "150"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    times: dict[str, float | None] = {}

    def report(*_: object) -> None:
        total = round(sum(t for t in times.values() if t is not None), 3)
        sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
        print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}), flush=True)

    def stopped(*_: object) -> None:
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, stopped)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.files.maxPartitionBytes": "4m",
            "spark.sql.files.openCostInBytes": "262144",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_project"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        times[name] = timed(spark, name, sf_dir, limit)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
