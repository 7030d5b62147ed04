"""Queries over single operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from strataflux import schemas
from strataflux.functions.times import add_day
from strataflux.operators import incremental, joins, merge, quality
from strataflux.operators.conform import cast_to_schema, not_null_violations
from strataflux.operators.summary import daily_summary
from strataflux.sources.files import read_files, stamp_load_time
from strataflux.sources.sinks import replace_partitions
from strataflux.session import scratch
from workloads.data import FIRST_LOAD, arrivals, plain_time, readings, table

LINE_KEYS = ["l_orderkey", "l_linenumber"]


def raw_readings(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf)


# Sources


def _ingest(spark: SparkSession, sf: str, file_format: str, header: bool, declared: bool) -> DataFrame:
    folder = scratch(spark, f"landing-{file_format}")
    writer = arrivals(spark, sf).write.format(file_format)
    if file_format == "csv":
        writer = writer.option("header", str(header).lower())
    writer.save(folder)
    schema = schemas.ARRIVAL if declared else None
    found = read_files(spark, folder, file_format, header, schema)
    return plain_time(stamp_load_time(found, FIRST_LOAD), "load_datetime")


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf, "csv", header=True, declared=True)


def csv_ingest_undeclared(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf, "csv", header=True, declared=False)


def csv_ingest_headerless(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf, "csv", header=False, declared=True)


def json_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf, "json", header=True, declared=True)


def orc_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf, "orc", header=True, declared=False)


def parquet_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest(spark, sf, "parquet", header=True, declared=False)


# Quality


def split_complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_nulls(readings(spark, sf), schemas.MEASURES)[0]


def split_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_nulls(readings(spark, sf), schemas.MEASURES)[1]


def split_partly_filled_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_nulls(readings(spark, sf), schemas.MEASURES, how="all")[0]


def split_empty_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_nulls(readings(spark, sf), schemas.MEASURES, how="all")[1]


def split_valid(spark: SparkSession, sf: str) -> DataFrame:
    complete, _ = quality.split_nulls(readings(spark, sf), schemas.MEASURES)
    return quality.split_rules(complete, quality.reading_rules())[0]


def split_invalid(spark: SparkSession, sf: str) -> DataFrame:
    complete, _ = quality.split_nulls(readings(spark, sf), schemas.MEASURES)
    return quality.split_rules(complete, quality.reading_rules())[1]


def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return quality.split_with_reason(
        readings(spark, sf), schemas.MEASURES, quality.reading_rules(), notes=quality.number_notes()
    )[1]


def reject_log(spark: SparkSession, sf: str) -> DataFrame:
    """Both kinds of rejects, written as one batch, twice; the log holds them once."""
    complete, nulls = quality.split_nulls(readings(spark, sf), schemas.MEASURES)
    _, invalid = quality.split_rules(complete, quality.reading_rules())
    rows = quality.reject_log(nulls, invalid).withColumn("batch_id", F.lit("20240301_060000_000000"))
    path = scratch(spark, "error-log")
    for _ in range(2):
        replace_partitions(rows, path, ["batch_id"], spread="evenly")
    return spark.read.parquet(path).drop("batch_id")


def cast_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    typed = cast_to_schema(readings(spark, sf), schemas.SILVER)
    return plain_time(typed, "timestamp")


def cast_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    wanted = StructType(
        [
            StructField("l_quantity", IntegerType()),
            StructField("l_extendedprice", IntegerType()),
            StructField("l_discount", StringType()),
            StructField("l_returnflag", DoubleType()),
            StructField("l_shipdate", TimestampNTZType()),
            StructField("not_there", DoubleType()),
        ]
    )
    as_text = lines.withColumns(
        {
            "l_quantity": F.col("l_quantity").cast("string"),
            "l_extendedprice": F.col("l_extendedprice").cast("string"),
            "l_shipdate": F.date_format("l_shipdate", "yyyy-MM-dd"),
        }
    )
    return cast_to_schema(as_text, wanted)


def not_null_counts(spark: SparkSession, sf: str) -> DataFrame:
    demanding = StructType([StructField(f.name, f.dataType, False) for f in schemas.ARRIVAL])
    typed = cast_to_schema(readings(spark, sf), schemas.SILVER)
    return not_null_violations(typed, demanding)


# Incremental reads and joins


def newer_than_mark(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderdate", "l_shipdate")
    return incremental.newer_than(table(spark, sf, "lineitem"), orders, "l_shipdate")


def newer_than_default_mark(spark: SparkSession, sf: str) -> DataFrame:
    nothing = table(spark, sf, "events").where("value < 0")
    return incremental.newer_than(table(spark, sf, "events"), nothing, "ts")


def touched_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier-days with a line shipped after the middle of the period."""
    lines = add_day(table(spark, sf, "lineitem"), "l_shipdate")
    since = FIRST_LOAD.replace(year=1998, hour=0, tzinfo=None)
    return incremental.touched_groups(lines, ["l_suppkey", "date"], "l_shipdate", since)


PARTY_DAY = [("l_suppkey", "o_custkey"), ("l_shipdate", "o_orderdate")]
ORDER_LINE = [("o_orderkey", "l_orderkey")]


def unseen_groups(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unseen(table(spark, sf, "lineitem"), table(spark, sf, "orders"), PARTY_DAY)


def seen_groups(spark: SparkSession, sf: str) -> DataFrame:
    return joins.seen(table(spark, sf, "lineitem"), table(spark, sf, "orders"), PARTY_DAY)


def unseen_orders(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unseen(table(spark, sf, "orders"), table(spark, sf, "lineitem"), ORDER_LINE)


def seen_orders(spark: SparkSession, sf: str) -> DataFrame:
    return joins.seen(table(spark, sf, "orders"), table(spark, sf, "lineitem"), ORDER_LINE)


def _order_lines(spark: SparkSession, sf: str, how: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return joins.key_join(orders, lines, ORDER_LINE, how)


def matched_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _order_lines(spark, sf, "inner")


def matched_left(spark: SparkSession, sf: str) -> DataFrame:
    return _order_lines(spark, sf, "left")


def matched_right(spark: SparkSession, sf: str) -> DataFrame:
    return _order_lines(spark, sf, "right")


def matched_full(spark: SparkSession, sf: str) -> DataFrame:
    return _order_lines(spark, sf, "full")


# Merges: finished and pending orders are stored, pending and open ones arrive changed.


def _stored_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderstatus IN ('F', 'P')")


def _arriving_orders(spark: SparkSession, sf: str) -> DataFrame:
    arriving = table(spark, sf, "orders").where("o_orderstatus IN ('P', 'O')")
    return arriving.withColumns({"o_totalprice": F.col("o_totalprice") + 1, "o_orderstatus": F.lit("R")})


def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_insert_only(_arriving_orders(spark, sf), _stored_orders(spark, sf), ["o_orderkey"])


def merge_insert_only_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Line keys repeat on both sides; every copy of a new key is inserted."""
    lines = table(spark, sf, "lineitem")
    return merge.merge_insert_only(
        lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'"), LINE_KEYS
    )


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_update_insert(
        _arriving_orders(spark, sf), _stored_orders(spark, sf), ["o_orderkey"]
    )


def merge_upsert_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Of several arriving lines for one key the last shipped replaces what is stored."""
    lines = table(spark, sf, "lineitem")
    return merge.upsert(
        lines.where("l_linestatus = 'O'"), lines.where("l_linestatus = 'F'"), LINE_KEYS, ["l_shipdate"]
    )


def merge_keys_only(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_update_insert(
        _arriving_orders(spark, sf), _stored_orders(spark, sf), ["o_orderkey"], ["o_orderkey"]
    )


def merge_one_column(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_update_insert(
        _arriving_orders(spark, sf), _stored_orders(spark, sf), ["o_orderkey"], ["o_totalprice"]
    )


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge.latest_per_key(table(spark, sf, "lineitem"), LINE_KEYS, ["l_shipdate"])


# Summaries


def _event_summary(spark: SparkSession, sf: str, unit: str, name: str) -> DataFrame:
    events = table(spark, sf, "events").selectExpr(f"{unit} AS {name}", "ts", "value AS power_output")
    return daily_summary(add_day(events, "ts"), [name, "date"])


def daily_summary_turbines(spark: SparkSession, sf: str) -> DataFrame:
    return _event_summary(spark, sf, "CAST(user_id % 15 AS INT)", "turbine_id")


def daily_summary_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return _event_summary(spark, sf, "user_id", "user_id")


def daily_summary_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return _event_summary(spark, sf, "event_type", "event_type")


def daily_summary_shipping(spark: SparkSession, sf: str) -> DataFrame:
    lines = add_day(table(spark, sf, "lineitem"), "l_shipdate")
    return daily_summary(lines, ["l_returnflag", "l_linestatus", "date"], "l_extendedprice")


def daily_summary_valid(spark: SparkSession, sf: str) -> DataFrame:
    """Valid readings, typed, reduced to one per key and summarised, without tables between."""
    typed = cast_to_schema(split_valid(spark, sf).select(*schemas.ARRIVAL.names), schemas.SILVER)
    kept = merge.latest_per_key(typed, schemas.READING_KEYS)
    return cast_to_schema(daily_summary(add_day(kept, "timestamp")), schemas.GOLD)
