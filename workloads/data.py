"""The given tables, and turbine readings derived from all rows of ``events``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux import schemas
from strataflux.session import ZONE_SETTING

FIRST_LOAD = datetime(2024, 3, 1, 6, 0, 0, tzinfo=timezone.utc)


def load_moment(delivery: int) -> datetime:
    """Load time of a delivery, counted from 1."""
    return FIRST_LOAD.replace(day=delivery)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; days and zone-less times are read in UTC."""
    spark.conf.set(ZONE_SETTING, "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _values(text: str, whole_division: str) -> str:
    """Measures with gaps, stray text, fractions, wide angles and negative power.

    One text for both engines, which name the text type and whole division differently.
    """
    return f"""
        CASE WHEN event_id % 17 = 0 THEN NULL
             WHEN event_id % 41 = 0 THEN 'bad'
             WHEN event_id % 37 = 0 THEN '10d'
             WHEN event_id % 43 = 0 THEN '0x1p3'
             ELSE concat(CAST(((event_id * 7) % 300) {whole_division} 10 AS {text}), '.',
                         CAST((event_id * 7) % 10 AS {text}))
        END AS wind_speed,
        CASE WHEN event_id % 23 = 0 THEN NULL
             ELSE CAST((event_id * 13) % 380 AS {text})
        END AS wind_direction,
        CASE WHEN event_id % 29 = 0 THEN NULL
             WHEN event_type = 'error' AND event_id % 5 = 0 THEN concat('-', CAST(value AS {text}))
             ELSE CAST(value AS {text})
        END AS power_output"""


READINGS_SQL = f"""SELECT event_id, ts AS reading_ts, event_type,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS timestamp,
        CAST(user_id % 15 AS VARCHAR) AS turbine_id,{_values('VARCHAR', '//')}
    FROM events"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event: 15 turbines, every column as text beside the typed time."""
    return spark.sql(
        f"""SELECT event_id, ts AS reading_ts, event_type,
        date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS timestamp,
        CAST(user_id % 15 AS STRING) AS turbine_id,{_values('STRING', 'div')}
    FROM {{events}}""",
        events=table(spark, sf_dir, "events"),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as they arrive in files."""
    return readings(spark, sf_dir).select(*schemas.ARRIVAL.names)


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """Instants shown as UTC clock times, the form the comparing engine uses."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in columns})
