"""One pass over pending rows: each gets its verdict, is staged by it and is counted on the way."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strataflux import schemas
from strataflux.operators.quality import REASON, missing
from strataflux.plans.days import DAY
from strataflux.sources.sinks import replace_partitions, stage
from strataflux.sources.tables import Layers, read_dataset, read_partitions

BATCH = schemas.BATCH_PARTITION.name
VERDICT = "verdict"
ACCEPTED, REJECTED = "accepted", "rejected"
STAGED = StructType([*schemas.ERROR_LOG.fields, schemas.BATCH_PARTITION, StructField(VERDICT, StringType())])
COUNTS = ("n_rows", "n_with_gaps", "n_rejected", "n_days")
RUNS = StructType([*[StructField(name, LongType()) for name in COUNTS], schemas.BATCH_PARTITION])


@dataclass(frozen=True)
class Verdicts:
    """Staged rows by verdict, and what was seen of all of them while they were staged."""

    accepted: DataFrame
    rejected: DataFrame
    days: list[date]
    batches: list[str]
    counts: dict[str, int]


def stage_verdicts(spark: SparkSession, judged: DataFrame, path: str, null_columns: Sequence[str]) -> Verdicts:
    """Write rows that carry their reason and their day, in one scan and without a shuffle.

    The driver gets counts, calendar days and batch names. The job has a single stage of tasks that
    each count once, when they succeed, so a lost executor cannot make a row count twice.
    """
    seen = Observation()
    watched = judged.observe(
        seen,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(missing(null_columns)).alias("n_with_gaps"),
        F.count(REASON).alias("n_rejected"),
        F.collect_set(DAY).alias("days"),
        F.collect_set(BATCH).alias("batches"),
    )
    verdict = F.when(F.col(REASON).isNull(), ACCEPTED).otherwise(REJECTED)
    stage(watched.withColumn(VERDICT, verdict).select(*STAGED.names), path, [VERDICT], spread="as is")
    found = seen.get
    days = sorted(found.get("days") or [])
    counts = {name: found.get(name) or 0 for name in COUNTS[:-1]} | {"n_days": len(days)}
    accepted, rejected = [read_partitions(spark, path, STAGED, VERDICT, [kind]) for kind in (ACCEPTED, REJECTED)]
    return Verdicts(accepted, rejected, days, sorted(found.get("batches") or []), counts)


def record_run(spark: SparkSession, layers: Layers, batch: str, counts: dict[str, int]) -> None:
    """Note what a silver run up to a batch has seen; doing it again replaces the note."""
    noted = spark.createDataFrame([(*[counts[name] for name in COUNTS], batch)], RUNS)
    replace_partitions(noted, layers.silver_runs, [BATCH], spread="as is")


def read_runs(spark: SparkSession, layers: Layers) -> DataFrame:
    """One row per silver run: its last batch and how many rows it saw, had gaps, were rejected, on how many days."""
    return read_dataset(spark, layers.silver_runs, RUNS).select(BATCH, *COUNTS)
