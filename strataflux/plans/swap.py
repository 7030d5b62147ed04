"""Merge rows into a table partitioned by day, safely against a crash at any point."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strataflux import schemas
from strataflux.operators.merge import upsert
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.days import DAY, Days
from strataflux.plans.file_swap import FileSwap
from strataflux.sources.sinks import replace_partitions, stage
from strataflux.sources.tables import Layers, partition_folders, read_dataset, read_partitions

MergeNote = Callable[..., None]


@dataclass(frozen=True)
class DayTable:
    """A table partitioned by day that one job merges into."""

    spark: SparkSession
    layers: Layers
    name: str
    path: str
    schema: StructType
    keys: Sequence[str]
    # One row per group and day, so days take next to no bytes.
    is_narrow: bool = False

    @property
    def stored(self) -> StructType:
        return schemas.stored(self.schema, schemas.DAILY_PARTITIONS)

    @property
    def log(self) -> BatchLog:
        return BatchLog(self.spark, self.layers.batch_log)

    @property
    def staged_mark(self) -> str:
        return f"{self.name} staged"

    def rows(self) -> DataFrame:
        """The table with its day column."""
        return read_dataset(self.spark, self.path, self.stored)

    def on(self, days: Days) -> DataFrame:
        """The rows of some days; only their folders are listed, however old the table is."""
        return read_partitions(self.spark, self.path, self.stored, DAY, days)

    @property
    def swap(self) -> FileSwap:
        return FileSwap(self.spark, self.path, self.layers.staging(self.name))

    def is_new(self) -> bool:
        """Whether the table has no day yet."""
        return not partition_folders(self.spark, self.path, DAY)

    def resume(self, marks: dict[str, str]) -> bool:
        """Finish a swap that broke off after staging, and its batch with it.

        True when there was one; the marks are brought up to date. Where another job has rewritten a
        day meanwhile, what was staged for it no longer fits: the batch is merged once more.
        """
        staged = marks[self.staged_mark]
        if staged <= marks[self.name] or self.swap.finish():
            return False
        self.log.record(self.name, staged)
        marks[self.name] = staged
        return True

    def merge(self, incoming: DataFrame, days: Days, batch: str, note: MergeNote | None = None) -> None:
        """Upsert rows that hold one row per key; only the days they fall on are touched.

        Sound because the day is a function of the key. Days new to the table are written
        straight away: nothing in the table depends on them, so a broken run is simply
        repeated. Days that exist are merged into a staging path first, and only then are its files
        moved in: should the move break off, the complete days are still at hand. A merged row
        is written once.

        ``note`` is called before the batch counts as staged, with the incoming rows, those held and those
        merged on the days held, or without any where all days were new.
        """
        incoming = incoming.select(*self.stored.names)
        folders = partition_folders(self.spark, self.path, DAY, days) if days else []
        if not folders:
            replace_partitions(incoming, self.path, [DAY], self.keys, folders=len(days) if self.is_narrow else 0)
            if note is not None:
                note()
            return
        # An upsert uses the incoming rows twice, for their keys and as rows; they are made once. They are
        # always read whole, so no folder for each day.
        ready = self.layers.staging(f"{self.name}_incoming")
        stage(incoming, ready, [], spread="as is")
        incoming = read_dataset(self.spark, ready, self.stored)
        # Only folders of these days are listed, however old the table is.
        held = [folder.rpartition("/")[2] for folder in folders]
        touched = self.swap.begin(held, self.stored)
        merged = upsert(incoming, touched, self.keys, source_is_keyed=True)
        stage(merged, self.swap.staged, [DAY], self.keys, folders=len(days) if self.is_narrow else 0)
        if note is not None:
            known = [folder.partition("=")[2] for folder in held]
            note(incoming, touched, read_partitions(self.spark, self.swap.staged, self.stored, DAY, known))
        self.log.record(self.staged_mark, batch)
        if self.swap.finish():
            raise RuntimeError(f"{self.name} was rewritten by another job meanwhile; run this one again")


def silver_table(spark: SparkSession, layers: Layers) -> DayTable:
    return DayTable(spark, layers, "silver", layers.silver, schemas.SILVER, schemas.READING_KEYS)


def gold_table(spark: SparkSession, layers: Layers) -> DayTable:
    return DayTable(spark, layers, "gold", layers.gold, schemas.GOLD, schemas.SUMMARY_KEYS, is_narrow=True)
