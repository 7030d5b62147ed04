"""Bronze: arriving files, as text, with the load time of their batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflux import schemas
from strataflux.functions.times import batch_name
from strataflux.operators.merge import absent_rows
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.days import day_values
from strataflux.session import session_zone
from strataflux.sources.files import (
    move_files,
    read_files,
    reading_files,
    stamp_load_time,
    with_source_file,
)
from strataflux.sources.registry import register_files
from strataflux.sources.sinks import remove_partitions, replace_partitions
from strataflux.sources.tables import (
    Layers,
    no_rows,
    partition_folders,
    read_dataset,
    read_partitions,
)

BATCH = schemas.BATCH_PARTITION.name
ARRIVAL_DAY = schemas.ARRIVAL_DAY_PARTITION.name
STORED = schemas.BRONZE_AT_REST
FILES = StructType([StructField("path", StringType()), schemas.BATCH_PARTITION])


def read_bronze(spark: SparkSession, layers: Layers) -> DataFrame:
    return read_dataset(spark, layers.bronze, STORED)


def named_day(time_text: Column) -> Column:
    """The day a timestamp text begins with, NULL when it begins with none.

    It depends on the text alone, so readings with the same key share it.
    """
    return F.substring(time_text, 1, 10).try_cast("date")


def load_arrivals(
    spark: SparkSession,
    layers: Layers,
    arrivals: DataFrame,
    moment: datetime,
    mode: str = "insert_only",
    keys: Sequence[str] = tuple(schemas.READING_KEYS),
) -> bool:
    """Store one batch of arrivals; False when this batch was complete already.

    ``insert_only`` skips rows whose key an earlier batch delivered, reading the keys of the
    arriving days only; ``append`` keeps every delivery. A batch has partitions of its own
    and the merge looks at other batches, so loading it again after a failure gives the same
    table; what a broken-off load has left of the batch is removed first.
    """
    if mode not in ("insert_only", "append"):
        raise ValueError(f"mode must be 'insert_only' or 'append', not {mode!r}")
    batch = batch_name(moment)
    log = BatchLog(spark, layers.batch_log)
    if log.holds("bronze", batch):
        return False
    if batch <= log.mark("silver"):
        raise ValueError(f"batch {batch} lies before the last batch silver has read; use a later load time")
    with session_zone(spark, "UTC"):
        for field in (schemas.SOURCE_FILE, schemas.MALFORMED_LINE):
            if field.name not in arrivals.columns:
                arrivals = arrivals.withColumn(field.name, F.lit(None).cast(field.dataType))
        kept = [*schemas.BRONZE.names, schemas.SOURCE_FILE.name, schemas.MALFORMED_LINE.name]
        stamped = stamp_load_time(arrivals, moment).select(*kept)
        new = stamped.withColumns({ARRIVAL_DAY: named_day(F.col("timestamp")), BATCH: F.lit(batch)})
        if mode == "insert_only":
            if partition_folders(spark, layers.bronze, ARRIVAL_DAY):
                days = day_values(new, ARRIVAL_DAY)
                same_days = read_partitions(spark, layers.bronze, STORED, ARRIVAL_DAY, days)
                new = absent_rows(new, same_days.where(F.col(BATCH) != batch), keys)
        remove_partitions(spark, layers.bronze, BATCH, batch)
        replace_partitions(new, layers.bronze, [ARRIVAL_DAY, BATCH], keys)
    log.record("bronze", batch)
    return True


def bronze(
    spark: SparkSession,
    layers: Layers,
    moment: datetime,
    mode: str = "insert_only",
    landing: str | None = None,
    file_format: str = "csv",
    has_header: bool = True,
    skip_redelivered: bool = False,
) -> bool:
    """Load everything in the landing folder as one batch, then move its files to ``processed``.

    The files are listed once and noted before they are read, so exactly those are loaded and moved
    that were there then; they keep their places below ``processed/<batch>``. A run that broke
    off before its log entry starts anew with what is there; one that broke off later moves
    the rest of its files when it is repeated.

    ``skip_redelivered`` reads the files once more for their contents and leaves out those that an earlier
    such batch has had, whatever they are called; they are moved like the others. It matters most
    under ``append``, where a file sent again would add all its rows again.
    """
    batch, place = batch_name(moment), landing or layers.landing
    schema, options = reading_files(schemas.ARRIVAL, file_format)
    if BatchLog(spark, layers.batch_log).holds("bronze", batch):
        files = read_dataset(spark, layers.arrived_files, FILES).where(F.col(BATCH) == batch)
        move_files(spark, [row["path"] for row in files.collect()], place, f"{layers.processed}/{batch}")
        return False
    files = read_files(spark, place, file_format, has_header, schema=schema).inputFiles()
    if files:
        noted = spark.createDataFrame([(file, batch) for file in files], FILES)
        replace_partitions(noted, layers.arrived_files, [BATCH], spread="as is")
    loaded = files
    if skip_redelivered:
        loaded = register_files(spark, layers.landed_files, files, place, batch)
    if loaded:
        # Listed names are URIs, readers take plain paths.
        named = [unquote(file) for file in loaded]
        arrivals = read_files(spark, named, file_format, has_header, schema=schema, **options)
        arrivals = with_source_file(arrivals)
    else:
        arrivals = no_rows(spark, schema)
    stored = load_arrivals(spark, layers, arrivals, moment, mode)
    move_files(spark, files, place, f"{layers.processed}/{batch}")
    return stored
