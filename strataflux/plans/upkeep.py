"""Layout jobs: the same rows in better files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflux import schemas
from strataflux.functions.times import batch_name
from strataflux.operators.layout import interleaved, order_by_keys
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.file_swap import FileSwap
from strataflux.sources.files import stored_bytes, stored_files
from strataflux.sources.sinks import stage, write_new
from strataflux.sources.tables import MISSING, Layers, quoted_name, quoted_text, read_dataset

FILE_BYTES = 256 * 1024 * 1024


def recluster(
    spark: SparkSession,
    source_path: str,
    new_path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write a dataset to a new path, cut and sorted by its keys.

    Readers move to the new path when it is complete; the old one is never touched.
    """
    rows = spark.read.parquet(source_path)
    files = max(1, ceil(stored_bytes(spark, source_path) / file_bytes))
    order = [*partition_by, *[key for key in keys if key not in partition_by]]
    write_new(order_by_keys(rows, order, files), new_path, partition_by)


def table_location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_name(name)}")
    return described.where(F.col("col_name") == "Location").first()["data_type"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def recluster_table(
    spark: SparkSession,
    name: str,
    keys: Sequence[str],
    new_location: str,
    file_bytes: int = FILE_BYTES,
    together: bool = False,
) -> None:
    """Re-lay out a catalog table by keys; its name stays.

    An unpartitioned table is written to ``new_location`` and its name pointed there. The folders of a
    partitioned one stay where the catalog has them, and each gets new files; ``new_location`` then
    holds the run's notes and staged files. ``together`` clusters on all keys alike (see ``interleaved``)
    in place of one after the other.
    """
    rows, location = spark.read.table(name), table_location(spark, name)
    if partitions := partition_columns(spark, name):
        run = batch_name(datetime.now(timezone.utc))
        compact(spark, location, rows.schema, partitions, keys, new_location, run, file_bytes, True, together)
        spark.catalog.refreshTable(name)
        return
    files = max(1, ceil(stored_bytes(spark, location) / file_bytes))
    ordered = interleaved(rows, keys, files) if together else order_by_keys(rows, keys, files)
    write_new(ordered, new_location)
    spark.sql(f"ALTER TABLE {quoted_name(name)} SET LOCATION {quoted_text(new_location)}")
    spark.catalog.refreshTable(name)


def fragmented(
    spark: SparkSession, path: str, partitions: Sequence[str], file_bytes: int = FILE_BYTES, everything: bool = False
) -> DataFrame:
    """Partitions whose files are many and, on average, below a quarter of the wanted size, or all.

    One row each, with the partition's values as text, NULL for missing ones, and its folder. Judged from the file
    listing alone; no data is read. Files that lie in other folders than these partition columns
    make, in this order, are an error: rewriting them would mix two layouts.
    """
    files = stored_files(spark, path)
    layout = "".join(f"/{name}=([^/]+)" for name in partitions)
    odd = ~F.col("path").rlike(f"/[^/=]+{layout}/[^/=]+$")
    if not files.where(odd).isEmpty():
        raise ValueError(f"{path} is not laid out by {list(partitions)}")
    texts = [F.url_decode(F.regexp_extract("path", layout + "/[^/=]+$", k + 1)) for k in range(len(partitions))]
    values = [F.nullif(text, F.lit(MISSING)).alias(name) for text, name in zip(texts, partitions, strict=True)]
    folder = F.regexp_extract("path", f"/({layout[1:]})/[^/=]+$", 1).alias("folder")
    sizes = files.groupBy(*values, folder).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    enough = F.greatest(F.lit(1), F.ceil(F.col("bytes") / (file_bytes / 4)))
    return sizes if everything else sizes.where(F.col("files") > enough)


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partitions: str | Sequence[str],
    sort_by: Sequence[str],
    state_path: str,
    batch: str,
    file_bytes: int = FILE_BYTES,
    everything: bool = False,
    together: bool = False,
) -> list:
    """Rewrite fragmented partitions in place, or all with ``everything``, and return their values.

    ``partitions`` are all partition columns of the table, in order. The new files are complete in a
    staging path before the old ones go, and take the place of exactly the files they were made from:
    rows others append meanwhile, or after a run that broke off, stay, and a partition that others have
    replaced is left for the next run. ``batch`` names the run and must sort after the names of
    all earlier runs, as ``batch_name`` of the time does; a run that broke off in between is
    finished by the next one. ``together`` clusters rows on all of ``sort_by`` alike.
    """
    names = [partitions] if isinstance(partitions, str) else list(partitions)
    log = BatchLog(spark, f"{state_path}/compact_log")

    def swap_of(run: str) -> FileSwap:
        return FileSwap(spark, path, f"{state_path}/compact_staging/{run}")

    last = log.mark("staged")
    if batch <= last:
        raise ValueError(f"run {batch!r} does not come after the last run, {last!r}")
    for run in log.unfinished("staged", "done"):
        swap_of(run).finish()
        log.record("done", run)
    found = fragmented(spark, path, names, file_bytes, everything).select(*names, "folder").collect()
    found = sorted(found, key=lambda row: [(row[name] is not None, row[name] or "") for name in names])
    if not found:
        return []
    swap = swap_of(batch)
    rows = swap.begin([row["folder"] for row in found], schema)
    if together:
        files = max(1, ceil(stored_bytes(spark, path) / file_bytes))
        ordered = interleaved(rows, sort_by, files, names)
        ordered.write.mode("overwrite").partitionBy(*names).parquet(swap.staged)
    else:
        stage(rows, swap.staged, names, sort_by)
    log.record("staged", batch)
    changed = set(swap.finish())
    log.record("done", batch)
    done = [row for row in found if row["folder"] not in changed]
    return [row[names[0]] for row in done] if isinstance(partitions, str) else [tuple(row)[:-1] for row in done]


def compact_layers(
    spark: SparkSession,
    layers: Layers,
    moment: datetime,
    file_bytes: int = FILE_BYTES,
    everything: bool = False,
    together: bool = False,
) -> dict:
    """Compact bronze, silver, the error log and gold; the rewritten partitions of each.

    With ``everything`` all partitions are rewritten; ``together`` clusters rows on all keys alike. A long
    batch log is folded; a job that reads it at that moment may fail and is repeated.
    """
    tables = {
        "bronze": (layers.bronze, schemas.BRONZE_AT_REST, schemas.BRONZE_PARTITIONS, schemas.READING_KEYS),
        "silver": (layers.silver, schemas.SILVER, schemas.DAILY_PARTITIONS, schemas.READING_KEYS),
        "error_log": (layers.error_log, schemas.ERROR_LOG, schemas.ERROR_LOG_PARTITIONS, schemas.READING_KEYS),
        "gold": (layers.gold, schemas.GOLD, schemas.DAILY_PARTITIONS, schemas.SUMMARY_KEYS),
    }
    done = {}
    for name, (path, schema, partitions, keys) in tables.items():
        stored = schemas.stored(schema, partitions)
        if read_dataset(spark, path, stored).isEmpty():
            continue
        columns = [field.name for field in partitions]
        state = layers.staging(f"upkeep_{name}")
        run = batch_name(moment)
        done[name] = compact(spark, path, stored, columns, keys, state, run, file_bytes, everything, together)
    BatchLog(spark, layers.batch_log).fold()
    return done
