"""

Input is every event of the given scale as a reading, for MEASURE_COPIES parks of turbines.
Medians of BENCH_REPEATS warm runs (three unless set).
"""

from __future__ import annotations

import os
import sys
from datetime import datetime, timezone
from functools import cache
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pyspark  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import bench  # noqa: E402
from strataflux import schemas  # noqa: E402
from strataflux.functions.times import add_day  # noqa: E402
from strataflux.operators import merge, quality  # noqa: E402
from strataflux.operators.conform import cast_to_schema  # noqa: E402
from strataflux.operators.summary import daily_summary  # noqa: E402
from strataflux.plans.bronze import load_arrivals  # noqa: E402
from strataflux.plans.days import DAY, day_values, on_days  # noqa: E402
from strataflux.plans.gold import gold, summarise  # noqa: E402
from strataflux.plans.silver import silver  # noqa: E402
from strataflux.plans.swap import DayTable  # noqa: E402
from strataflux.plans.upkeep import recluster  # noqa: E402
from strataflux.session import scratch  # noqa: E402
from strataflux.sources.sinks import append_rows, replace_partitions, write_new  # noqa: E402
from strataflux.sources.tables import Layers  # noqa: E402
from strataflux.streaming.arrivals import start_arrivals  # noqa: E402
from workloads import oracles  # noqa: E402
from workloads.data import arrivals, load_moment  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
COPIES = int(os.environ.get("MEASURE_COPIES", "1"))
TURBINES = 15
KEYS = schemas.READING_KEYS

spark = bench.session()
lines: list[str] = []


def report(what: str, ours: float, other_name: str, other: float) -> None:
    lines.append(f"| {what} | {ours:.3f} s | {other_name}: {other:.3f} s |")
    print(lines[-1], flush=True)


@cache
def readings() -> DataFrame:
    """The readings as text, stored once."""
    parks = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    number = F.col("turbine_id").cast("int") + F.col("park") * TURBINES
    rows = arrivals(spark, SF_DIR).withColumn("park", parks).repartition(int(bench.CPUS))
    path = scratch(spark, "readings")
    write_new(rows.withColumn("turbine_id", number.cast("string")).drop("park"), path)
    return spark.read.parquet(path)


@cache
def typed() -> DataFrame:
    rows = add_day(cast_to_schema(readings(), schemas.SILVER), "timestamp")
    return spark.read.parquet(stored(rows, None))


def stored(df: DataFrame, partition: str | None = DAY) -> str:
    path = scratch(spark, "measure")
    if partition:
        replace_partitions(df, path, [partition], KEYS)
    else:
        write_new(df, path)
    return path


def summaries() -> None:
    connection = duckdb.connect()
    connection.execute(f"SET threads TO {bench.CPUS}")
    silver_rows = typed().where("power_output IS NOT NULL")
    path = stored(silver_rows, None)
    sql = oracles.summary(f"'{path}/*.parquet'", "turbine_id, date")
    report(
        "daily summary of all readings",
        bench.seconds(lambda: bench.consume(daily_summary(spark.read.parquet(path)))),
        "same query in DuckDB",
        bench.seconds(lambda: connection.execute(sql).fetchall()),
    )


def splits() -> None:
    texts = readings()
    rules = quality.reading_rules()

    def two_steps() -> None:
        complete, nulls = quality.split_nulls(texts, schemas.MEASURES)
        valid, invalid = quality.split_rules(complete, rules)
        bench.consume(valid)
        bench.consume(quality.reject_log(nulls, invalid))

    def one_step() -> None:
        notes = quality.number_notes()
        for part in quality.split_with_reason(texts, schemas.MEASURES, rules, notes=notes):
            bench.consume(part)

    report("split with reasons", bench.seconds(one_step), "separate splits, no reasons", bench.seconds(two_steps))


def insert_only() -> None:
    rows = typed()
    for share, since in ((1, "2024-01-30 17:00:00"), (10, "2024-01-28 00:00:00"), (100, "2024-01-01 00:00:00")):
        first = F.lit(since).cast("timestamp")
        path = stored(rows.where(F.col("timestamp") < first) if share < 100 else rows)
        target, source = spark.read.parquet(path), rows.where(F.col("timestamp") >= first)

        def ours(target=target, source=source) -> None:
            pruned = target.where(on_days(day_values(source)))
            append_rows(merge.absent_rows(source, pruned, KEYS), scratch(spark, "added"), [DAY], KEYS)

        def rewrite(target=target, source=source) -> None:
            append_rows(merge.merge_insert_only(source, target, KEYS), scratch(spark, "rewrite"), [DAY], KEYS)

        report(
            f"insert-only merge, source about {share} % of the target",
            bench.seconds(ours),
            "rewrite of the table",
            bench.seconds(rewrite),
        )


def upserts() -> None:
    rows = typed()
    path = stored(rows)
    target = spark.read.parquet(path)
    for label, days in (("1 day", ["2024-01-15"]), ("all days", None)):
        source = rows if days is None else rows.where(F.col(DAY).isin([F.lit(d).cast("date") for d in days]))

        table = DayTable(spark, Layers(scratch(spark, "merged")), "silver", stored(rows), schemas.SILVER, KEYS)

        def ours(source=source, table=table) -> None:
            """The job's own merge, with its staging and its log entry."""
            newest = merge.latest_per_key(source, KEYS)
            table.merge(newest, day_values(source), "run")

        def rewrite(source=source) -> None:
            replace_partitions(merge.upsert(source, target, KEYS), scratch(spark, "upsert"), [DAY], KEYS)

        report(f"upsert touching {label}", bench.seconds(ours), "rewrite of the table", bench.seconds(rewrite))


def gold_increment() -> None:
    rows = readings()
    last = F.col("timestamp") >= "2024-01-30"
    moment = datetime(2024, 3, 1, tzinfo=timezone.utc)

    def prepared() -> Layers:
        layers = Layers(scratch(spark, "gold"))
        load_arrivals(spark, layers, rows.where(~last), moment)
        silver(spark, layers)
        gold(spark, layers)
        load_arrivals(spark, layers, rows.where(last), moment.replace(day=2))
        silver(spark, layers)
        return layers

    ready = iter([prepared() for _ in range(bench.REPEATS + 1)])
    some = prepared()
    full = spark.read.parquet(some.silver)
    report(
        "gold after one new day",
        bench.seconds(lambda: gold(spark, next(ready))),
        "summary of all days, written",
        bench.seconds(
            lambda: replace_partitions(summarise(full), scratch(spark, "full"), [DAY], schemas.SUMMARY_KEYS)
        ),
    )


def scanned_rows(df: DataFrame) -> int:
    """Rows that leave the scan, from the metrics of the executed plan."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan()
    found = leaf.collectLeaves()
    return sum(found.apply(i).metrics().apply("numOutputRows").value() for i in range(found.size()))


def key_lookup() -> None:
    lines_path = f"{SF_DIR}/lineitem.parquet"
    path = scratch(spark, "clustered")
    recluster(spark, lines_path, path, ["l_orderkey", "l_linenumber"], file_bytes=512 * 1024)
    wanted = F.col("l_orderkey") == 4242

    def look(where: str) -> DataFrame:
        return spark.read.parquet(where).where(wanted)

    report(
        f"lookup of one key, clustered ({scanned_rows(look(path))} rows scanned)",
        bench.seconds(lambda: look(path).collect()),
        f"as given ({scanned_rows(look(lines_path))} rows scanned)",
        bench.seconds(lambda: look(lines_path).collect()),
    )


def streaming() -> None:
    rows = readings()
    folder = scratch(spark, "daily-files")
    (
        rows.withColumn("part", F.to_date("timestamp"))
        .repartition("part")
        .drop("part")
        .write.option("header", "true")
        .csv(folder)
    )

    def stream() -> None:
        layers = Layers(scratch(spark, "stream"))
        spark.read.option("header", "true").schema(schemas.ARRIVAL).csv(folder).write.option(
            "header", "true"
        ).csv(layers.landing)
        start_arrivals(spark, layers, clock=lambda: load_moment(1)).awaitTermination()

    def batch() -> None:
        layers = Layers(scratch(spark, "batch"))
        files = spark.read.option("header", "true").schema(schemas.ARRIVAL).csv(folder)
        files.write.option("header", "true").csv(layers.landing)
        load_arrivals(spark, layers, spark.read.option("header", "true").schema(schemas.ARRIVAL).csv(layers.landing), load_moment(1))

    report("bronze as a file stream", bench.seconds(stream), "as one batch", bench.seconds(batch))


if __name__ == "__main__":
    scale = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(
        f"PySpark {pyspark.__version__}, DuckDB {duckdb.__version__}, {bench.CPUS} cores, "
        f"{readings().count()} readings (sf{scale} x {COPIES})"
    )
    print("| measurement | ours | plain alternative |\n| --- | --- | --- |")
    for step in (summaries, splits, insert_only, upserts, gold_increment, key_lookup, streaming):
        step()
