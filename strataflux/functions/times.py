"""Days, batch names and batch times."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from strataflux.schemas import DAY_LABEL

MICROS_PER_DAY = 86_400_000_000
BATCH_FORMAT = "%Y%m%d_%H%M%S_%f"


def utc(moment: datetime) -> datetime:
    """The moment with an explicit zone; one without a zone is taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def batch_name(moment: datetime) -> str:
    """Partition value of the batch loaded at this moment; text order is time order."""
    return utc(moment).strftime(BATCH_FORMAT)


def batch_moment(name: str) -> datetime:
    """The moment a batch name stands for."""
    return datetime.strptime(name, BATCH_FORMAT).replace(tzinfo=timezone.utc)


def add_day(df: DataFrame, time_column: str, out: str = "date", zone: str = "UTC") -> DataFrame:
    """Append the calendar day of a time column in the given zone, not the session's."""
    moment = F.col(time_column)
    if isinstance(df.schema[time_column].dataType, TimestampType):
        micros = F.unix_micros(F.from_utc_timestamp(moment, zone))
        midnight = micros - F.pmod(micros, F.lit(MICROS_PER_DAY))
        return df.withColumn(out, F.date_from_unix_date((midnight / MICROS_PER_DAY).cast("int")))
    return df.withColumn(out, F.to_date(moment))


def day_label(day: Column) -> Column:
    """Day as the text used in the names of daily files."""
    return F.date_format(day, DAY_LABEL)
