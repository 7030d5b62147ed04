"""Headline timings; prints one JSON line.

Each operator query runs into Spark's no-op sink, so all rows are computed and none are
collected. Every query runs once to warm up; the median of the following runs counts. The
layered runs write their tables anew each time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from strataflux.session import SETTINGS  # noqa: E402
from workloads import jobs, operators  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

OPERATORS = [
    "csv_ingest",
    "split_valid",
    "split_invalid",
    "reject_reasons",
    "cast_to_silver",
    "not_null_counts",
    "newer_than_mark",
    "unseen_groups",
    "unseen_orders",
    "matched_left",
    "merge_insert_only",
    "merge_upsert",
    "merge_upsert_repeats",
    "latest_per_key",
    "daily_summary_turbines",
    "daily_summary_by_user",
    "daily_summary_shipping",
    "daily_summary_valid",
]

RUNS = {
    "one_batch": jobs.one_batch,
    "first_delivery_wins": jobs.first_delivery_wins,
    "corrections": jobs.corrections,
    "streamed": jobs.streamed,
}


def session(cpus: str = CPUS) -> SparkSession:
    folder = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("strataflux-bench")
    own = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.warehouse.dir": f"{folder}/warehouse",
        "spark.checkpoint.dir": f"{folder}/shared",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.fileSource.cleaner.numThreads": "0",
    }
    for name, value in {**SETTINGS, **own}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(work: Callable[[], object], repeats: int = REPEATS) -> float:
    """Median time after one run to warm up."""
    times = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    timings = {
        name: seconds(lambda name=name: consume(getattr(operators, name)(spark, SF_DIR)))
        for name in OPERATORS
    }
    for name, run in RUNS.items():
        timings[name] = seconds(lambda run=run: run.__wrapped__(spark, SF_DIR), min(REPEATS, 2))
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, medians of warm runs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
