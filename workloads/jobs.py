"""Queries over the jobs: tables are written to the shared folder and read back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from strataflux import schemas
from strataflux.functions.times import add_day, batch_name
from strataflux.operators.summary import daily_summary
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.bronze import ARRIVAL_DAY, BATCH, bronze, read_bronze
from strataflux.plans.file_swap import FileSwap
from strataflux.plans.gold import gold, read_gold
from strataflux.plans.silver import read_error_log, read_silver, silver
from strataflux.plans.stored_merge import merge_into_path, merge_into_table
from strataflux.plans.upkeep import compact, compact_layers, recluster, recluster_table
from strataflux.plans.verdicts import read_runs
from strataflux.session import scratch
from strataflux.sources import sinks, tables
from strataflux.sources.registry import read_registry
from strataflux.sources.tables import Layers
from strataflux.streaming.arrivals import process_arrivals
from workloads.data import arrivals, load_moment, plain_time, readings, table

Deliver = Callable[[int], DataFrame]


def land(rows: DataFrame, layers: Layers, delivery: int) -> str:
    """Write one delivery of CSV files below the landing folder and return its folder."""
    folder = f"{layers.landing}/delivery_{delivery}"
    rows.write.option("header", "true").csv(folder)
    return folder


def in_parts(spark: SparkSession, sf: str) -> Deliver:
    """Three deliveries that overlap: days 1-10, 6-20 and 16 to the end.

    A later delivery of a reading carries another wind direction, to tell them apart.
    """
    day = F.dayofmonth(F.to_date("timestamp"))
    spans = {1: (1, 10), 2: (6, 20), 3: (16, 31)}

    def deliver(number: int) -> DataFrame:
        first, last = spans[number]
        rows = arrivals(spark, sf).where(day.between(first, last))
        if number == 1:
            return rows
        marked = F.when(F.col("wind_direction").isNotNull(), F.lit(str(number * 45)))
        return rows.withColumn("wind_direction", marked)

    return deliver


def late(spark: SparkSession, sf: str) -> Deliver:
    """Two deliveries over the same days: views and clicks first, everything else late."""
    early = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))

    def deliver(number: int) -> DataFrame:
        rows = readings(spark, sf).where(early if number == 1 else ~early)
        return rows.select(*schemas.ARRIVAL.names)

    return deliver


def run_batches(
    spark: SparkSession, deliver: Deliver, deliveries: int, bronze_mode: str, gold_mode: str
) -> Layers:
    layers = Layers(scratch(spark, "layers"))
    for number in range(1, deliveries + 1):
        folder = land(deliver(number), layers, number)
        bronze(spark, layers, load_moment(number), bronze_mode, landing=folder)
        silver(spark, layers)
        gold(spark, layers, gold_mode)
    return layers


# Several queries read different tables of one run; a run is made once per session.


@cache
def one_batch(spark: SparkSession, sf: str) -> Layers:
    return run_batches(spark, lambda _: arrivals(spark, sf), 1, "insert_only", "unseen")


@cache
def first_delivery_wins(spark: SparkSession, sf: str) -> Layers:
    return run_batches(spark, in_parts(spark, sf), 3, "insert_only", "unseen")


@cache
def corrections(spark: SparkSession, sf: str) -> Layers:
    return run_batches(spark, in_parts(spark, sf), 3, "append", "touched")


@cache
def late_ignored(spark: SparkSession, sf: str) -> Layers:
    return run_batches(spark, late(spark, sf), 2, "insert_only", "unseen")


@cache
def late_included(spark: SparkSession, sf: str) -> Layers:
    return run_batches(spark, late(spark, sf), 2, "insert_only", "touched")


def clock_of_deliveries() -> Iterator[datetime]:
    number = 0
    while True:
        number += 1
        yield load_moment(number)


@cache
def streamed(spark: SparkSession, sf: str) -> Layers:
    """The overlapping deliveries, each picked up by a run of the file stream."""
    deliver, clock = in_parts(spark, sf), clock_of_deliveries()
    layers = Layers(scratch(spark, "stream"))
    for number in (1, 2, 3):
        deliver(number).write.mode("append").option("header", "true").csv(layers.landing)
        process_arrivals(spark, layers, clock=lambda: next(clock))
    return layers


def _bronze(layers: Layers, spark: SparkSession) -> DataFrame:
    return plain_time(read_bronze(spark, layers).select(*schemas.BRONZE.names), "load_datetime")


def _silver(layers: Layers, spark: SparkSession) -> DataFrame:
    return plain_time(read_silver(spark, layers), "load_datetime", "timestamp")


def _errors(layers: Layers, spark: SparkSession) -> DataFrame:
    return plain_time(read_error_log(spark, layers), "load_datetime")


def layered_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(one_batch(spark, sf), spark)


def layered_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(one_batch(spark, sf), spark)


def layered_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(one_batch(spark, sf), spark)


def layered_gold(spark: SparkSession, sf: str) -> DataFrame:
    return read_gold(spark, one_batch(spark, sf))


def increments_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(first_delivery_wins(spark, sf), spark)


def increments_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(first_delivery_wins(spark, sf), spark)


def increments_gold(spark: SparkSession, sf: str) -> DataFrame:
    return read_gold(spark, first_delivery_wins(spark, sf))


def corrections_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(corrections(spark, sf), spark)


def corrections_errors(spark: SparkSession, sf: str) -> DataFrame:
    return _errors(corrections(spark, sf), spark)


def silver_run_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What every run of silver saw of its batch while it judged the rows."""
    return read_runs(spark, corrections(spark, sf))


def corrections_gold(spark: SparkSession, sf: str) -> DataFrame:
    return read_gold(spark, corrections(spark, sf))


def late_unseen_gold(spark: SparkSession, sf: str) -> DataFrame:
    return read_gold(spark, late_ignored(spark, sf))


def late_touched_gold(spark: SparkSession, sf: str) -> DataFrame:
    return read_gold(spark, late_included(spark, sf))


def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(streamed(spark, sf), spark)


def stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(streamed(spark, sf), spark)


def stream_gold(spark: SparkSession, sf: str) -> DataFrame:
    return read_gold(spark, streamed(spark, sf))


# Daily files, layout and catalog


def split_by_day(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "daily")
    sinks.split_by_day(arrivals(spark, sf), path)
    stored = StructType([*schemas.ARRIVAL.fields, StructField("day", schemas.ARRIVAL[0].dataType)])
    return spark.read.schema(stored).option("header", "true").csv(path)


def reclustered(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "clustered")
    recluster(
        spark, f"{sf}/lineitem.parquet", path, ["l_orderkey", "l_linenumber"], file_bytes=256 * 1024
    )
    return spark.read.parquet(path)


def reclustered_table(spark: SparkSession, sf: str) -> DataFrame:
    name = f"orders_{uuid4().hex}"
    table(spark, sf, "orders").write.option("path", scratch(spark, "orders")).saveAsTable(name)
    recluster_table(spark, name, ["o_custkey", "o_orderdate"], scratch(spark, "orders"), 64 * 1024)
    return spark.read.table(name)


def compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Days written by several appends, brought back to few files each."""
    path = scratch(spark, "events")
    events = add_day(table(spark, sf, "events"), "ts")
    for part in range(3):
        sinks.append_rows(events.where(F.col("event_id") % 3 == part), path, ["date"])
    stored = StructType([*events.drop("date").schema.fields, StructField("date", DateType())])
    compact(
        spark, path, stored, "date", ["user_id", "ts"], scratch(spark, "state"), batch_name(load_moment(1))
    )
    return spark.read.schema(stored).parquet(path)


def compacted_after_append(spark: SparkSession, sf: str) -> DataFrame:
    """Compaction that broke off once its files were staged, rows appended to the same days, and the next run."""
    path, state = scratch(spark, "events"), scratch(spark, "state")
    events = add_day(table(spark, sf, "events"), "ts")
    for part in range(3):
        sinks.append_rows(events.where(F.col("event_id") % 4 == part), path, ["date"])
    stored = StructType([*events.drop("date").schema.fields, StructField("date", DateType())])
    first, second = batch_name(load_moment(1)), batch_name(load_moment(2))
    broken = FileSwap(spark, path, f"{state}/compact_staging/{first}")
    folders = [folder.rpartition("/")[2] for folder in tables.partition_folders(spark, path, "date")]
    sinks.stage(broken.begin(folders, stored), broken.staged, ["date"], ["user_id", "ts"])
    BatchLog(spark, f"{state}/compact_log").record("staged", first)
    sinks.append_rows(events.where(F.col("event_id") % 4 == 3), path, ["date"])
    compact(spark, path, stored, "date", ["user_id", "ts"], state, second)
    return spark.read.schema(stored).parquet(path)


def archived_files(spark: SparkSession, sf: str) -> DataFrame:
    """Where the rows' files are after two runs and a third delivery that no run has seen."""
    layers, deliver = Layers(scratch(spark, "archived")), in_parts(spark, sf)
    for number in (1, 2):
        land(deliver(number), layers, number)
        bronze(spark, layers, load_moment(number), "append", landing=f"{layers.landing}/delivery_{number}")
    land(deliver(3), layers, 3)

    def rows_in(folder: str, place: str) -> DataFrame:
        found = spark.read.schema(schemas.ARRIVAL).option("header", "true").option("recursiveFileLookup", "true")
        return found.csv(folder).withColumn("place", F.lit(place))

    found = rows_in(f"{layers.processed}/{batch_name(load_moment(1))}", "first run")
    found = found.unionAll(rows_in(f"{layers.processed}/{batch_name(load_moment(2))}", "second run"))
    return found.unionAll(rows_in(layers.landing, "landing"))


@cache
def redelivered(spark: SparkSession, sf: str) -> Layers:
    """The first delivery, then it once more under other names beside the second one, then both again."""
    layers, deliver = Layers(scratch(spark, "redelivered")), in_parts(spark, sf)
    for number, sent in ((1, (1,)), (2, (1, 2)), (3, (2, 1))):
        folder = f"{layers.landing}/day_{number}"
        for delivery in sent:
            rows = deliver(delivery).repartition(3, "turbine_id", "timestamp")
            rows.write.mode("append").option("header", "true").csv(folder)
        bronze(spark, layers, load_moment(number), "append", landing=folder, skip_redelivered=True)
    return layers


def redelivered_file(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze where every delivery is appended, files sent again are not."""
    return _bronze(redelivered(spark, sf), spark)


def landed_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in new and in redelivered files of each batch, by the registry; a file's header is no row."""
    found = read_registry(spark, redelivered(spark, sf).landed_files)
    return found.groupBy("batch_id", "kind").agg(F.sum(F.col("n_lines") - 1).alias("n_rows"))


def bronze_repeated_run(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over one delivery, rows without a key among it."""
    layers = Layers(scratch(spark, "repeated"))
    rows = arrivals(spark, sf)
    without = F.when(F.substring("timestamp", -1, 1) != "3", F.col("timestamp"))
    folder = land(rows.withColumn("timestamp", without), layers, 1)
    for number in (1, 2, 3):
        bronze(spark, layers, load_moment(number), landing=folder)
    return _bronze(layers, spark)


def _days_or_none(spark: SparkSession, sf: str) -> DataFrame:
    """Events with their day, which every seventh lacks."""
    events = add_day(table(spark, sf, "events"), "ts")
    return events.withColumn("date", F.when(F.col("event_id") % 7 != 0, F.col("date")))


def compacted_null_day(spark: SparkSession, sf: str) -> DataFrame:
    """As ``compacted``, with rows that have no day."""
    path = scratch(spark, "events")
    events = _days_or_none(spark, sf)
    for part in range(3):
        sinks.append_rows(events.where(F.col("event_id") % 3 == part), path, ["date"])
    stored = StructType([*events.drop("date").schema.fields, StructField("date", DateType())])
    done = compact(
        spark, path, stored, ["date"], ["user_id", "ts"], scratch(spark, "state"), batch_name(load_moment(1))
    )
    if (None,) not in done:
        raise RuntimeError("the rows without a day were not compacted")
    return spark.read.schema(stored).parquet(path)


def compacted_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze, partitioned by day and batch, after upkeep of all layers, and read by the jobs again."""
    layers = run_batches(spark, in_parts(spark, sf), 3, "insert_only", "unseen")
    # Another writer's small files, as many appends leave them.
    split = read_bronze(spark, layers).where(F.col(BATCH) == batch_name(load_moment(2)))
    aside = scratch(spark, "aside")
    split.write.parquet(aside)
    split = spark.read.schema(split.schema).parquet(aside)
    sinks.remove_partitions(spark, layers.bronze, BATCH, batch_name(load_moment(2)))
    for part in range(2):
        picked = split.where(F.pmod(F.xxhash64("timestamp"), F.lit(2)) == part)
        sinks.append_rows(picked, layers.bronze, [ARRIVAL_DAY, BATCH])
    if not compact_layers(spark, layers, load_moment(20))["bronze"]:
        raise RuntimeError("nothing was compacted")
    return _bronze(layers, spark)


def stream_old_file(spark: SparkSession, sf: str) -> DataFrame:
    """The second of three deliveries lands with files dated a month back."""
    deliver, clock = in_parts(spark, sf), clock_of_deliveries()
    layers = Layers(scratch(spark, "stream"))
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    for number in (1, 2, 3):
        landed = f"{layers.root}/sent_{number}"
        deliver(number).write.option("header", "true").csv(landed)
        root = jvm.org.apache.hadoop.fs.Path(landed)
        system = root.getFileSystem(context.hadoopConfiguration())
        landing = jvm.org.apache.hadoop.fs.Path(layers.landing)
        system.mkdirs(landing)
        for found in system.globStatus(jvm.org.apache.hadoop.fs.Path(root, "part-*")):
            path = found.getPath()
            if number == 2:
                system.setTimes(path, found.getModificationTime() - 30 * 86_400_000, -1)
            system.rename(path, jvm.org.apache.hadoop.fs.Path(landing, f"{number}-{path.getName()}"))
        process_arrivals(spark, layers, clock=lambda: next(clock))
    return _bronze(layers, spark)


def _orders_in_two(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored orders, and arriving ones of which some correct stored ones; every order is in either."""
    orders = table(spark, sf, "orders")
    stored = orders.where("o_orderkey % 3 != 0")
    changed = F.when(F.col("o_orderkey") % 2 == 0, F.lit("X")).otherwise(F.col("o_orderstatus"))
    arriving = orders.where("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0")
    return stored, arriving.withColumn("o_orderstatus", changed)


def merge_into_orders(spark: SparkSession, sf: str) -> DataFrame:
    """A merge into a catalog table by name."""
    stored, arriving = _orders_in_two(spark, sf)
    name = f"orders_{uuid4().hex}"
    stored.write.option("path", scratch(spark, "orders")).saveAsTable(name)
    merge_into_table(spark, name, arriving, ["o_orderkey"], scratch(spark, "orders"))
    return spark.read.table(name)


def merge_into_orders_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """A merge into a partitioned catalog table by name; some rows change their partition."""
    stored, arriving = _orders_in_two(spark, sf)
    name = f"orders_{uuid4().hex}"
    stored.write.option("path", scratch(spark, "orders")).partitionBy("o_orderstatus").saveAsTable(name)
    merge_into_table(spark, name, arriving, ["o_orderkey"], scratch(spark, "orders"))
    return spark.read.table(name)


def _registered(spark: SparkSession, layers: Layers) -> str:
    """Catalog names over layers that jobs have written; their common prefix."""
    prefix = f"t{uuid4().hex}_"
    if failed := tables.create_layers(spark, layers, prefix):
        raise RuntimeError(failed)
    tables.register_new_partitions(spark, [f"{prefix}silver.silver_turbines"])
    return prefix


def merge_into_silver_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Corrected power readings merged into the silver table by its name."""
    layers = run_batches(spark, lambda _: arrivals(spark, sf), 1, "insert_only", "unseen")
    name = f"{_registered(spark, layers)}silver.silver_turbines"
    corrected = spark.read.table(name).where("turbine_id % 4 = 1")
    corrected = corrected.withColumn("power_output", F.col("power_output") * 2)
    merge_into_table(spark, name, corrected, schemas.READING_KEYS, scratch(spark, "merge"))
    return plain_time(spark.read.table(name).select(*schemas.SILVER.names), "load_datetime", "timestamp")


def reclustered_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The silver table rewritten by its name, clustered on both merge columns alike."""
    layers = run_batches(spark, in_parts(spark, sf), 3, "insert_only", "unseen")
    name = f"{_registered(spark, layers)}silver.silver_turbines"
    recluster_table(spark, name, schemas.READING_KEYS, scratch(spark, "recluster"), 64 * 1024, together=True)
    return plain_time(spark.read.table(name).select(*schemas.SILVER.names), "load_datetime", "timestamp")


def merge_into_orders_by_status(spark: SparkSession, sf: str) -> DataFrame:
    """A merge into a partitioned dataset by path."""
    stored, arriving = _orders_in_two(spark, sf)
    path, new_path = scratch(spark, "orders"), scratch(spark, "orders")
    stored.write.partitionBy("o_orderpriority").parquet(path)
    merge_into_path(spark, path, new_path, arriving, ["o_orderkey"], ["o_orderpriority"])
    return spark.read.parquet(new_path)


def catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables created by name, filled by the jobs and by appending, read by name."""
    layers, prefix = Layers(scratch(spark, "catalog")), f"t{uuid4().hex}_"
    failed = tables.create_layers(spark, layers, prefix)
    if failed:
        raise RuntimeError(failed)
    bronze(spark, layers, load_moment(1), landing=land(arrivals(spark, sf), layers, 1))
    silver(spark, layers)
    name = f"{prefix}silver.silver_turbines"
    tables.register_new_partitions(spark, [name])
    typed = spark.read.table(name).select("turbine_id", "timestamp", "power_output", "date")
    tables.append_to_table(daily_summary(typed), f"{prefix}gold.gold_turbines")
    return spark.read.table(f"{prefix}gold.gold_turbines").select(*schemas.GOLD.names)


@cache
def named_batches(spark: SparkSession, sf: str) -> str:
    """Overlapping deliveries through tables that the catalog knows from the start; the prefix of their names."""
    layers, prefix, deliver = Layers(scratch(spark, "named")), f"t{uuid4().hex}_", in_parts(spark, sf)
    if failed := tables.create_layers(spark, layers, prefix):
        raise RuntimeError(failed)
    for number in (1, 2, 3):
        bronze(spark, layers, load_moment(number), landing=land(deliver(number), layers, number))
        silver(spark, layers, name=prefix + tables.SILVER_NAME)
        gold(spark, layers, "touched", name=prefix + tables.GOLD_NAME)
    return prefix


def named_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver read by name; no partition was searched for."""
    held = spark.read.table(named_batches(spark, sf) + tables.SILVER_NAME).select(*schemas.SILVER.names)
    return plain_time(held, "load_datetime", "timestamp")


def named_gold(spark: SparkSession, sf: str) -> DataFrame:
    """Gold read by name; no partition was searched for."""
    return spark.read.table(named_batches(spark, sf) + tables.GOLD_NAME).select(*schemas.GOLD.names)
