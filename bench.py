"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median
counts; the longest queries run once. Results are consumed in full by the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from airlag.plans.queries import QUERIES  # noqa: E402
from airlag.session import get_spark  # noqa: E402

HEADLINE = [
    "silver_clean",
    "silver_dedup",
    "airline_delay",
    "airport_delay",
    "route_delay",
    "time_delay",
    "silver_overview",
    "delay_histogram",
    "airline_origin_hour",
    "ml_features",
    "merge_upsert",
    "compact",
    "zorder_layout",
    "sample_exact",
    "roc_auc",
    "bronze_scan",
    "stratified_split",
    "ridge_regression",
    "pipeline_end_to_end",
]
# Timed once, without a warm-up run.
ONCE = {"ridge_regression", "pipeline_end_to_end"}


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.getenv("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.getenv("BENCH_CPUS", "8")
    runs = int(os.getenv("BENCH_RUNS", "3"))
    names = os.getenv("BENCH_QUERIES", "").split() or HEADLINE
    spark = get_spark(
        "airlag-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        if name not in ONCE:
            run(spark, name, sf_dir)
        times = 1 if name in ONCE else runs
        seconds[name] = round(
            statistics.median(run(spark, name, sf_dir) for _ in range(times)), 3
        )
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
