"""Which batches each stage has finished.

An entry is written last, after everything it stands for, so a run that breaks off is done
again from the same point. Marks are batch names; their text order is their time order.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflux.sources.tables import read_dataset

ENTRY = StructType([StructField("stage", StringType()), StructField("batch_id", StringType())])
NOTHING_DONE = ""
# A log of more files than this is worth rewriting; reading it lists and opens every one.
FOLD_OVER = 64


def moved_in(system: object, moves: list[tuple[object, object]]) -> None:
    for source, target in moves:
        if not system.rename(source, target):
            raise OSError(f"{source.toString()} could not be moved to {target.toString()}")


@dataclass(frozen=True)
class BatchLog:
    spark: SparkSession
    path: str

    def _entries(self) -> DataFrame:
        return read_dataset(self.spark, self.path, ENTRY)

    def record(self, stage: str, batch: str) -> None:
        entry = self.spark.range(1).select(F.lit(stage).alias("stage"), F.lit(batch).alias("batch_id"))
        entry.coalesce(1).write.mode("append").parquet(self.path)

    def fold(self, over: int = FOLD_OVER) -> bool:
        """Put all entries into one file once there are more files than ``over``; True when it was done.

        The new file is complete before it is moved in, and the old ones go after that: at no time is an
        entry missing, and one that stands twice means the same as one that stands once. Should it
        break off, the next call folds what is left.
        """
        jvm, context = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        new_path = jvm.org.apache.hadoop.fs.Path
        log, aside = new_path(self.path), new_path(f"{self.path.rstrip('/')}_folded")
        system = log.getFileSystem(context.hadoopConfiguration())

        def data_files(folder: object) -> list[object]:
            return [status.getPath() for status in system.globStatus(new_path(folder, "*.parquet")) or []]

        old = data_files(log)
        if len(old) <= over:
            return False
        entries = self.spark.read.schema(ENTRY).parquet(*[path.toString() for path in old]).distinct()
        entries.coalesce(1).write.mode("overwrite").parquet(aside.toString())
        moved_in(system, [(path, new_path(log, path.getName())) for path in data_files(aside)])
        for path in old:
            system.delete(path, False)
        return True

    def marks(self) -> dict[str, str]:
        """The last batch of every stage, read in one go; ``""`` for a stage without one."""
        newest = self._entries().groupBy("stage").agg(F.max("batch_id")).collect()
        return defaultdict(lambda: NOTHING_DONE, [tuple(row) for row in newest])

    def mark(self, stage: str) -> str:
        """The last batch of one stage; the entries of others stay on the executors."""
        newest = self._entries().where(F.col("stage") == stage).agg(F.max("batch_id")).first()[0]
        return newest or NOTHING_DONE

    def batches(self, stage: str) -> DataFrame:
        """The batches one stage has finished, each once."""
        return self._entries().where(F.col("stage") == stage).select("batch_id").distinct()

    def unfinished(self, begun: str, finished: str) -> list[str]:
        """Batches with an entry for one stage and none for another, in order."""
        entries = self._entries()
        ends = entries.where(F.col("stage") == finished).select("batch_id")
        open_ones = entries.where(F.col("stage") == begun).select("batch_id").join(ends, "batch_id", "left_anti")
        return sorted(row[0] for row in open_ones.distinct().collect())

    def holds(self, stage: str, batch: str) -> bool:
        same = (F.col("stage") == stage) & (F.col("batch_id") == batch)
        return not self._entries().where(same).isEmpty()
