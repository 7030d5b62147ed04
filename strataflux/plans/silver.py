"""Silver: new bronze rows, checked, typed and merged; rejects go to the error log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField

from strataflux import schemas
from strataflux.functions.numbers import conform, is_whole
from strataflux.functions.times import add_day
from strataflux.operators.conform import cast_to_schema
from strataflux.operators.merge import latest_per_key
from strataflux.operators.quality import number_notes, reading_rules, with_reason
from strataflux.plans.bronze import BATCH, read_bronze
from strataflux.plans.days import DAY, DayLog
from strataflux.plans.moment_log import MomentLog
from strataflux.plans.swap import silver_table
from strataflux.plans.verdicts import record_run, stage_verdicts
from strataflux.session import session_zone
from strataflux.sources.sinks import remove_partitions, replace_partitions
from strataflux.sources.tables import Layers, add_partitions, read_dataset


# The log entry for the zone whose days partition silver. In another zone the same instant may fall
# on another day, and its key would be stored twice.
ZONE_MARK = "silver zone"


def pending(spark: SparkSession, layers: Layers, mark: str, upto: str) -> DataFrame:
    """Bronze batches after the mark. Both ends are fixed before anything is read, so a
    batch that lands meanwhile waits for the next run."""
    return read_bronze(spark, layers).where((F.col(BATCH) > mark) & (F.col(BATCH) <= upto))


def typed_keys() -> dict[str, Column]:
    """What the NOT NULL columns of silver ask of a bronze row: values that can be cast.

    A whole-number key must be one already, else different keys would become the same.
    """
    have = {field.name: field.dataType for field in schemas.BRONZE}

    def castable(field: StructField) -> Column:
        column = F.col(field.name)
        fits = conform(column, have[field.name], field.dataType).isNotNull()
        if field.name in schemas.READING_KEYS and isinstance(field.dataType, IntegralType):
            return fits & is_whole(column)
        return fits

    demands = {
        f"{field.name} is not a valid {field.dataType.simpleString()}": castable(field)
        for field in schemas.SILVER
        if not field.nullable
    }
    return demands | {"the line does not have the declared fields": F.col(schemas.MALFORMED_LINE.name).isNull()}


def typed_rows(rows: DataFrame, zone: str = "UTC") -> DataFrame:
    """Bronze rows with silver's types, plus their day."""
    typed = cast_to_schema(rows.select(*schemas.SILVER.names), schemas.SILVER)
    return add_day(typed, "timestamp", DAY, zone)


def with_day(rows: DataFrame, zone: str = "UTC") -> DataFrame:
    """Bronze rows plus the day silver would file them under, NULL where there is none."""
    moment = conform(F.col("timestamp"), schemas.BRONZE["timestamp"].dataType, schemas.SILVER["timestamp"].dataType)
    return add_day(rows.withColumn("__moment", moment), "__moment", DAY, zone)


def silver(
    spark: SparkSession,
    layers: Layers,
    rules: Mapping[str, Column] | None = None,
    null_columns: Sequence[str] = tuple(schemas.MEASURES),
    zone: str = "UTC",
    name: str | None = None,
) -> str | None:
    """Process every pending batch; the last one processed, or None when there was none.

    The pending partitions are read once: every row is judged, counted and staged by its verdict in
    one pass without a shuffle. Rejects and good rows go on from there. ``name`` is the table's name in the
    catalog, which then sees the days of the batch without listing the others.
    """
    table = silver_table(spark, layers)
    with session_zone(spark, zone):
        marks = table.log.marks()
        if marks[ZONE_MARK] not in ("", zone):
            raise ValueError(f"silver holds days of zone {marks[ZONE_MARK]}, not {zone}")
        since, days = marks["silver"], DayLog(spark, layers.touched_days)
        resumed = table.resume(marks)
        if name is not None and marks["bronze"] > since:
            # Days that a broken-off run has written.
            add_partitions(spark, name, layers.silver, DAY, days.days(since, marks["bronze"]))
        mark, upto = marks["silver"], marks["bronze"]
        if upto <= mark:
            return mark if resumed else None
        if not marks[ZONE_MARK]:
            table.log.record(ZONE_MARK, zone)
        judged, notes = (reading_rules(), number_notes()) if rules is None else (rules, {})
        rows = with_reason(pending(spark, layers, mark, upto), null_columns, judged, typed_keys(), notes)
        seen = stage_verdicts(spark, with_day(rows, zone), layers.staging("silver_verdicts"), null_columns)
        for batch in seen.batches:
            # Rules may have changed since a run that broke off.
            remove_partitions(spark, layers.error_log, BATCH, batch)
        log_rows = seen.rejected.select(*schemas.ERROR_LOG.names, BATCH)
        replace_partitions(log_rows, layers.error_log, [BATCH], spread="evenly")
        newest = latest_per_key(typed_rows(seen.accepted, zone), schemas.READING_KEYS, ["load_datetime"])
        record_run(spark, layers, upto, seen.counts)
        noted = MomentLog(spark, layers)
        noted.forget(days.days(mark, upto), upto)
        days.record(upto, seen.days)

        def note(*rows: DataFrame) -> None:
            if rows:
                noted.add(*rows, seen.days, upto)
            else:
                noted.state(table.on(seen.days), seen.days, upto)

        table.merge(newest, [] if table.is_new() else seen.days, upto, note)
        if name is not None:
            add_partitions(spark, name, layers.silver, DAY, seen.days)
        table.log.record("silver", upto)
    return upto


def read_silver(spark: SparkSession, layers: Layers) -> DataFrame:
    """The silver table in its declared columns."""
    return silver_table(spark, layers).rows().select(*schemas.SILVER.names)


def read_error_log(spark: SparkSession, layers: Layers) -> DataFrame:
    stored = schemas.stored(schemas.ERROR_LOG, schemas.ERROR_LOG_PARTITIONS)
    return read_dataset(spark, layers.error_log, stored).select(*schemas.ERROR_LOG.names)
