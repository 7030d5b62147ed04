"""Bronze as a stream over the landing folder.

Each run takes the files that arrived since the last one, stores them batch by batch and
stops. The checkpoint knows which files belong to which batch; files are archived by the
source once a later batch has shown theirs to be complete, so a file can neither be moved
unread nor be read twice. A file counts as new by its path, however old it says it is.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from strataflux import schemas
from strataflux.functions.times import batch_moment, batch_name
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.bronze import load_arrivals
from strataflux.plans.gold import gold
from strataflux.plans.silver import silver
from strataflux.sources.files import csv_options, reading_files, with_source_file
from strataflux.sources.tables import GOLD_NAME, SILVER_NAME, Layers

Clock = Callable[[], datetime]

# By default files a week older than the newest one seen are passed over without a word. The
# source remembers what it has read for as long, which is what landing holds: the rest is archived.
MAX_FILE_AGE = "36500d"


def now() -> datetime:
    return datetime.now(timezone.utc)


def arriving_files(
    spark: SparkSession, landing: str, processed: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Stream of the rows of new CSV files; finished files go below ``processed``."""
    schema, options = reading_files(schemas.ARRIVAL)
    reader = spark.readStream.schema(schema).options(**csv_options(True, schema), **options)
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    if processed is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", processed)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_source_file(reader.csv(landing))


def load_times(layers: Layers) -> str:
    return f"{layers.arrivals_checkpoint}/load_times"


def load_time(spark: SparkSession, layers: Layers, epoch: int, clock: Clock) -> datetime:
    """The load time of a stream batch, the same one however often the batch is replayed.

    It is written down below the checkpoint before it is used, and always lies after every
    earlier batch.
    """
    times = BatchLog(spark, load_times(layers))
    known = times.mark(f"epoch {epoch}")
    if known:
        return batch_moment(known)
    moment = clock()
    log = BatchLog(spark, layers.batch_log)
    last = max(log.mark("bronze"), log.mark("silver"))
    if last and batch_name(moment) <= last:
        moment = batch_moment(last) + timedelta(microseconds=1)
    times.record(f"epoch {epoch}", batch_name(moment))
    return moment


def start_arrivals(
    spark: SparkSession,
    layers: Layers,
    mode: str = "insert_only",
    max_files: int | None = None,
    clock: Clock = now,
) -> StreamingQuery:
    """Start a run over the files present now; it ends by itself."""

    def store(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        load_arrivals(session, layers, batch, load_time(session, layers, epoch, clock), mode)

    files = arriving_files(spark, layers.landing, layers.processed, max_files)
    return (
        files.writeStream.foreachBatch(store)
        .option("checkpointLocation", f"{layers.arrivals_checkpoint}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def process_arrivals(
    spark: SparkSession,
    layers: Layers,
    mode: str = "insert_only",
    gold_mode: str = "unseen",
    max_files: int | None = None,
    clock: Clock = now,
    rules: Mapping[str, Column] | None = None,
    zone: str = "UTC",
    prefix: str | None = None,
) -> None:
    """Everything that has arrived, through all layers; what a file-arrival trigger calls.

    With the ``prefix`` that ``create_layers`` was given, the catalog sees the days of each run. The logs
    of batches and load times are folded into one file each where they have grown long.
    """
    start_arrivals(spark, layers, mode, max_files, clock).awaitTermination()
    names = [None, None] if prefix is None else [f"{prefix}{name}" for name in (SILVER_NAME, GOLD_NAME)]
    silver(spark, layers, rules, zone=zone, name=names[0])
    gold(spark, layers, gold_mode, name=names[1])
    for path in (layers.batch_log, load_times(layers)):
        BatchLog(spark, path).fold()
