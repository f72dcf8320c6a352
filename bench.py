"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
input and the number of local cores. Each query is warmed up until its time
settles and then timed three times; its median counts. A result is produced in
full and discarded.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from wickwork.plans.queries import REGISTRY
from wickwork.session import build_session
from wickwork.streaming.counters import Counters

HEADLINE = [
    "candles_hourly",
    "features_full",
    "features_by_user",
    "quality_report",
    "kline_roundtrip",
    "training_rows",
    "prediction_outcomes",
    "direction_accuracy",
    "stats_24h",
    "serving_rows",
    "csv_by_symbol",
]
# Jobs with a cost per run rather than per row; timed once after two runs at most.
JOBS = ["batch_job_report", "stream_features", "forest_predictions"]


def run(spark, name, folder) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def warm_up(spark, name, folder, most: int = 5) -> None:
    """Runs a query until a run is no more than a tenth faster than the one before."""
    last = run(spark, name, folder)
    for _ in range(most - 1):
        now = run(spark, name, folder)
        if now > 0.9 * last:
            return
        last = now


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    points = spark.read.parquet(f"{folder}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        warm_up(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(3)), 3)
    counters = Counters()
    for name in JOBS:
        warm_up(spark, name, folder, most=2)
        if name == "stream_features":
            spark.streams.addListener(counters)
        times[name] = round(run(spark, name, folder), 3)
        if name == "stream_features":
            spark.streams.removeListener(counters)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "points": points,
                "feature_points_per_sec": round(points / times["features_full"]),
                "stream_points_per_sec": round(points / times["stream_features"]),
                "stream_last_batch_ms": counters.last_batch_ms,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
