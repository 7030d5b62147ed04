"""Moments of turbine-days as silver's batches left them, so that gold need not read a day again.

Every silver batch notes the moments of the readings it added, one row per turbine-day. Where it
replaced a reading, or where a day has no note yet, it states the whole turbine-day instead; a statement
takes the place of all notes before it. Notes count once their batch is logged, so those of a run that
broke off mean nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from strataflux import schemas
from strataflux.operators.joins import same_keys, seen, unseen
from strataflux.operators.moments import MOMENTS, combined_moments, moments
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.days import DAY, Days, day_values, on_days
from strataflux.sources.sinks import replace_partitions
from strataflux.sources.tables import Layers, read_partitions

KEYS = schemas.SUMMARY_KEYS
BATCH = schemas.BATCH_PARTITION.name
VALUE = "power_output"
WHOLE = "is_whole"
NOTE = StructType(
    [
        *[field for field in schemas.GOLD if field.name in KEYS and field.name != DAY],
        *MOMENTS.fields,
        StructField(WHOLE, BooleanType()),
        schemas.DAY_PARTITION,
        schemas.BATCH_PARTITION,
    ]
)


@dataclass(frozen=True)
class MomentLog:
    spark: SparkSession
    layers: Layers

    def _on(self, days: Days, upto: str) -> DataFrame:
        """Notes of logged batches; only the folders of these days are listed."""
        notes = read_partitions(self.spark, self.layers.moments, NOTE, DAY, days)
        logged = BatchLog(self.spark, self.layers.batch_log).batches("silver")
        return notes.where(F.col(BATCH) <= upto).join(logged, BATCH, "left_semi")

    def _write(self, notes: DataFrame, days: Days, batch: str) -> None:
        rows = notes.withColumn(BATCH, F.lit(batch)).select(*NOTE.names)
        replace_partitions(rows, self.layers.moments, [DAY, BATCH], KEYS, folders=len(days))

    def forget(self, days: Iterable[date], batch: str) -> None:
        """Remove the notes of a run that broke off: made again, it may touch other days."""
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        for day in days:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.layers.moments}/{DAY}={day.isoformat()}/{BATCH}={batch}")
            path.getFileSystem(context.hadoopConfiguration()).delete(path, True)

    def state(self, rows: DataFrame, days: Days, batch: str) -> None:
        """Note the whole turbine-days of days the batch has written first."""
        self._write(moments(rows, KEYS, VALUE).withColumn(WHOLE, F.lit(True)), days, batch)

    def add(self, incoming: DataFrame, held: DataFrame, merged: DataFrame, days: Days, batch: str) -> None:
        """Note what a merge of ``incoming`` into ``held`` has added, for turbine-days it only added to.

        ``merged`` is looked at for the others alone, which ``held`` has rows of.
        """
        noted = day_values(self._on(days, batch))
        unknown = held.where(on_days([day for day in days if day not in set(noted)])).select(*KEYS)
        # Both hold the same keys; incoming rows are fewer and may be broadcast.
        replaced = seen(held, incoming, same_keys(schemas.READING_KEYS), target_is_keyed=True).select(*KEYS)
        restated = unknown.unionByName(replaced).distinct()
        only_added = unseen(moments(incoming, KEYS, VALUE), restated, same_keys(KEYS), target_is_keyed=True)
        whole = moments(seen(merged, restated, same_keys(KEYS), target_is_keyed=True), KEYS, VALUE)
        notes = only_added.withColumn(WHOLE, F.lit(False)).unionByName(whole.withColumn(WHOLE, F.lit(True)))
        self._write(notes, days, batch)

    def days(self, among: Days, since: str, upto: str) -> list[date]:
        """Which of some days have notes of the batches after one mark and up to another."""
        return day_values(self._on(among, upto).where(F.col(BATCH) > since))

    def touched(self, days: Days, since: str, upto: str) -> DataFrame:
        """Moments of the turbine-days of some days that batches after ``since`` have touched."""
        group = Window.partitionBy(*KEYS)
        last_statement = F.coalesce(F.max(F.when(F.col(WHOLE), F.col(BATCH))).over(group), F.lit(""))
        notes = self._on(days, upto).select(
            "*", last_statement.alias("__from"), F.max(BATCH).over(group).alias("__newest")
        )
        counting = notes.where((F.col("__newest") > since) & (F.col(BATCH) >= F.col("__from")))
        return combined_moments(counting, KEYS)
