"""Limit a read to calendar days, and remember which days a batch has touched."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflux import schemas
from strataflux.sources.sinks import replace_partitions
from strataflux.sources.tables import read_dataset

DAY = schemas.DAY_PARTITION.name
Days = Sequence[date | None]


def day_values(rows: DataFrame, column: str = DAY) -> list[date | None]:
    """The days a frame holds: one value per calendar day, whatever the number of rows.

    None stands for rows without a day.
    """
    return [row[0] for row in rows.select(column).distinct().collect()]


def on_days(days: Days, column: str = DAY) -> Column:
    """A filter of exactly these days, as literals, so partitions are pruned when the scan is planned."""
    known = [day for day in days if day is not None]
    if not known:
        chosen = F.lit(False)
    else:
        # One text is far quicker to hand over than a literal for each day.
        listed = ", ".join(f"DATE '{day.isoformat()}'" for day in known)
        chosen = F.expr(f"`{column}` IN ({listed})")
    return chosen if len(known) == len(days) else chosen | F.col(column).isNull()


@dataclass(frozen=True)
class DayLog:
    """The days each silver batch holds rows for, so gold need not search the whole table."""

    spark: SparkSession
    path: str

    def record(self, batch: str, days: Days) -> None:
        """Note the days of a batch; doing it again replaces the note."""
        known = [(day, batch) for day in days if day is not None]
        if known:
            noted = self.spark.createDataFrame(known, StructType([schemas.DAY_PARTITION, schemas.BATCH_PARTITION]))
            replace_partitions(noted.coalesce(1), self.path, [schemas.BATCH_PARTITION.name], spread="as is")

    def days(self, after: str, upto: str) -> list[date]:
        """Days of the batches after one mark and up to another."""
        stored = StructType([schemas.DAY_PARTITION, schemas.BATCH_PARTITION])
        batch = F.col(schemas.BATCH_PARTITION.name)
        return day_values(read_dataset(self.spark, self.path, stored).where((batch > after) & (batch <= upto)))
