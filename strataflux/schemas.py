"""Declared schemas of the layers and the fixed values of the turbine configuration."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Columns, keys, bounds and names of the turbine tables.
BRONZE = StructType(
    [
        StructField("load_datetime", TimestampType(), False),
        StructField("timestamp", StringType(), False),
        StructField("turbine_id", StringType(), False),
        StructField("wind_speed", StringType(), True),
        StructField("wind_direction", StringType(), True),
        StructField("power_output", StringType(), True),
    ]
)
SILVER = StructType(
    [
        StructField("load_datetime", TimestampType(), False),
        StructField("timestamp", TimestampType(), False),
        StructField("turbine_id", IntegerType(), False),
        StructField("wind_speed", DoubleType(), True),
        StructField("wind_direction", IntegerType(), True),
        StructField("power_output", DoubleType(), True),
    ]
)
GOLD = StructType(
    [
        StructField("turbine_id", IntegerType(), False),
        StructField("date", DateType(), False),
        StructField("avg_power_output", DoubleType(), False),
        StructField("min_power_output", DoubleType(), False),
        StructField("max_power_output", DoubleType(), False),
        StructField("is_anomaly", BooleanType(), False),
    ]
)
READING_KEYS = ["turbine_id", "timestamp"]
SUMMARY_KEYS = ["turbine_id", "date"]
MEASURES = ["wind_speed", "wind_direction", "power_output"]
WIND_SPEED_RANGE = (3, 25)
WIND_DIRECTION_RANGE = (0, 360)
POWER_OUTPUT_ABOVE = 0
ANOMALY_DEVIATIONS = 2.0
AVERAGE_DECIMALS = 2
FIRST_MARK = datetime(1900, 1, 1, tzinfo=timezone.utc)
DAY_LABEL = "yyyy_MM_dd"
DATABASES = ["raw", "bronze", "silver", "gold"]

# What lands: a bronze row before it is stamped, everything still text.
ARRIVAL = StructType([StructField(field.name, StringType()) for field in BRONZE if field.name != "load_datetime"])

# Rejected rows stay as they arrived and gain the reason.
ERROR_LOG = StructType([*BRONZE.fields, StructField("reject_reason", StringType())])

# Partition columns added at rest; they never show in the layer's own columns.
BATCH_PARTITION = StructField("batch_id", StringType(), True)
DAY_PARTITION = StructField("date", DateType(), True)


# Each layer's partitioning. Bronze is cut by the day its timestamp text names, which limits
# a merge to the days that arrive, and by batch, which limits silver to what is new.
ARRIVAL_DAY_PARTITION = StructField("day", DateType(), True)
BRONZE_PARTITIONS = [ARRIVAL_DAY_PARTITION, BATCH_PARTITION]
ERROR_LOG_PARTITIONS = [BATCH_PARTITION]
DAILY_PARTITIONS = [DAY_PARTITION]


# What bronze keeps beside its declared columns: the file a row came from, and its line where that
# does not have the declared fields.
SOURCE_FILE = StructField("source_file", StringType(), True)
MALFORMED_LINE = StructField("malformed_line", StringType(), True)


def stored(schema: StructType, partitions: list[StructField]) -> StructType:
    """The schema at rest: the layer's columns followed by its partition columns."""
    names = {field.name for field in partitions}
    return StructType([field for field in schema if field.name not in names] + partitions)


BRONZE_AT_REST = stored(StructType([*BRONZE.fields, SOURCE_FILE, MALFORMED_LINE]), BRONZE_PARTITIONS)
