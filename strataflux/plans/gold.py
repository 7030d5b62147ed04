"""Gold: power per turbine and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflux import schemas
from strataflux.functions.times import batch_moment
from strataflux.operators.conform import cast_to_schema
from strataflux.operators.incremental import touched_groups
from strataflux.operators.joins import same_keys, seen, unseen
from strataflux.operators.merge import absent_rows
from strataflux.operators.summary import daily_summary, summary_of_moments
from strataflux.plans.days import DAY, DayLog, Days, day_values, on_days
from strataflux.plans.moment_log import MomentLog
from strataflux.plans.swap import gold_table, silver_table
from strataflux.session import session_zone
from strataflux.sources.sinks import append_rows
from strataflux.sources.tables import Layers, add_partitions

KEYS = schemas.SUMMARY_KEYS
UNSEEN_MARK = "gold unseen"


def summarise(silver_rows: DataFrame) -> DataFrame:
    return cast_to_schema(daily_summary(silver_rows), schemas.GOLD)


def add_unseen(spark: SparkSession, layers: Layers, candidates: Days | None) -> None:
    """Summarise turbine-days gold does not hold and append them.

    Only the candidate days are searched, or all days if there are none given. The search
    reads key columns only and reduces them to groups before its one shuffle. Whole days
    are then summarised and known groups taken out of the result, so no join handles
    readings. Appending absent groups is safe to repeat.
    """
    tables = silver_table(spark, layers), gold_table(spark, layers)
    silver, gold = [table.rows() if candidates is None else table.on(candidates) for table in tables]
    if gold.isEmpty():
        append_rows(summarise(silver), layers.gold, [DAY], KEYS, folders=len(candidates or ()))
        return
    groups = silver.select(*KEYS).distinct()
    missing = unseen(groups, gold, same_keys(KEYS), target_is_keyed=True)
    days = day_values(missing)
    if days:
        summary = summarise(silver.where(on_days(days)))
        added = absent_rows(summary, gold, KEYS, target_is_keyed=True)
        append_rows(added, layers.gold, [DAY], KEYS, folders=len(days))


def refresh_touched(spark: SparkSession, layers: Layers, since: str, upto: str) -> None:
    """Summarise again every turbine-day that got readings since the last run.

    The moments silver has noted are enough. Days without a note, as silver wrote them before it took
    any, are read.
    """
    table, log = gold_table(spark, layers), MomentLog(spark, layers)
    days = DayLog(spark, layers.touched_days).days(since, upto)
    noted = log.days(days, since, upto)
    refreshed = cast_to_schema(summary_of_moments(log.touched(noted, since, upto)), schemas.GOLD)
    if others := sorted(set(days) - set(noted)):
        silver = silver_table(spark, layers).on(others)
        moment = batch_moment(since) if since else schemas.FIRST_MARK
        groups = touched_groups(silver, KEYS, "load_datetime", moment)
        again = seen(summarise(silver), groups, same_keys(KEYS), target_is_keyed=True)
        refreshed = refreshed.unionByName(again)
    table.merge(refreshed, days, upto)


def gold(
    spark: SparkSession,
    layers: Layers,
    mode: str = "unseen",
    whole_table: bool = False,
    name: str | None = None,
) -> str:
    """Bring gold up to the last silver batch and return that batch.

    ``unseen`` adds turbine-days gold does not hold and leaves the others as they are, late
    readings or not; ``touched`` summarises again what received readings since the last run
    in that mode, so it also makes up for late readings ``unseen`` has passed over. Either
    looks at the days silver has touched since its last run; ``whole_table`` lets ``unseen``
    search all days, as after rows were removed from gold by hand. ``name`` is the table's name in
    the catalog, which then sees the days it has looked at.
    """
    if mode not in ("unseen", "touched"):
        raise ValueError(f"mode must be 'unseen' or 'touched', not {mode!r}")
    table = gold_table(spark, layers)
    with session_zone(spark, "UTC"):
        marks = table.log.marks()
        stage = UNSEEN_MARK if mode == "unseen" else table.name
        everything = whole_table and mode == "unseen"
        before = marks[stage]
        table.resume(marks)
        since, upto = marks[stage], marks["silver"]
        looked_at = DayLog(spark, layers.touched_days).days(before, upto) if upto > before else []
        if everything:
            add_unseen(spark, layers, None)
        elif upto > since:
            if mode == "unseen":
                add_unseen(spark, layers, looked_at)
            else:
                refresh_touched(spark, layers, since, upto)
        if name is not None:
            add_partitions(spark, name, layers.gold, DAY, None if everything else looked_at)
        if upto <= since and not everything:
            return upto
        table.log.record(stage, upto)
    return upto


def read_gold(spark: SparkSession, layers: Layers) -> DataFrame:
    """The gold table in its declared columns."""
    return gold_table(spark, layers).rows().select(*schemas.GOLD.names)


__all__ = ["gold", "read_gold", "summarise"]
