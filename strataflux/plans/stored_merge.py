"""Merge rows into any stored Parquet dataset or catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.operators.joins import same_keys, seen
from strataflux.operators.layout import even_out
from strataflux.operators.merge import absent_rows, merge_insert_only, merge_update_insert
from strataflux.plans.file_swap import FileSwap, places_of
from strataflux.plans.upkeep import partition_columns, table_location
from strataflux.sources.sinks import append_rows, stage, write_new
from strataflux.sources.tables import quoted_name, quoted_text


def merged(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    mode: str = "upsert",
    update_columns: Sequence[str] | None = None,
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """The target after the merge; ``mode`` is ``upsert`` or ``insert_only``."""
    if mode not in ("upsert", "insert_only"):
        raise ValueError(f"mode must be 'upsert' or 'insert_only', not {mode!r}")
    if mode == "insert_only":
        return merge_insert_only(source.select(*target.columns), target, keys)
    return merge_update_insert(source, target, keys, update_columns, newest_by)


def merge_into_path(
    spark: SparkSession,
    path: str,
    new_path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    **how,
) -> None:
    """Write what a dataset becomes by a merge to a new path; the old one is never touched.

    Readers move to the new path when it is complete, so a run that breaks off has changed nothing.
    """
    rows = merged(source, spark.read.parquet(path), keys, **how)
    write_new(even_out(rows, partition_by, keys), new_path, partition_by)


def merge_into_table(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], new_location: str, **how
) -> None:
    """Merge into a catalog table by name.

    An unpartitioned table is written to ``new_location`` and its name pointed there. Of a partitioned
    one just the files that hold a key of the source are rewritten, in their folders;
    ``new_location`` then holds the notes and staged files until they are swapped in, and a merge that broke
    off is repeated with the same one.
    """
    if partitions := partition_columns(spark, name):
        _merge_files(spark, name, source, keys, partitions, new_location, **how)
        return
    rows = merged(source, spark.read.table(name), keys, **how)
    write_new(even_out(rows, (), keys), new_location)
    spark.sql(f"ALTER TABLE {quoted_name(name)} SET LOCATION {quoted_text(new_location)}")
    spark.catalog.refreshTable(name)


def _merge_files(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], partitions: Sequence[str], state: str, **how
) -> None:
    location = table_location(spark, name)
    swap = FileSwap(spark, location, state)
    swap.resume()
    spark.catalog.refreshTable(name)
    target = spark.read.table(name)
    if how.get("mode") == "insert_only":
        append_rows(absent_rows(source.select(*target.columns), target, keys), location, partitions, keys)
    else:
        hit = target.select(*keys, F.col("_metadata.file_path").alias("__file"))
        hit = seen(hit, source, same_keys(keys)).select("__file").distinct()
        files = places_of(spark, location, [row[0] for row in hit.collect()])
        rows = swap.begin_files(files, target.schema)
        stage(merged(source, rows, keys, **how), swap.staged, partitions, keys)
        swap.ready()
        if swap.finish():
            raise RuntimeError(f"{name} was rewritten by another job meanwhile; merge again")
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
