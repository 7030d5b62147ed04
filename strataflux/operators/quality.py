"""Tell usable rows from unusable ones, and say why.

Each split is two filters over one input, so the parts are disjoint and lose nothing. They
are narrow: no shuffle, and both sides read the same pruned scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflux import schemas
from strataflux.functions.numbers import above, is_finite, within

REASON = "reject_reason"


def number_notes(columns: Sequence[str] = tuple(schemas.MEASURES)) -> dict[str, Column]:
    """What to add to a reason when a value is no number at all.

    Ranges refuse such values too, so these explain a rejection and need not decide it.
    """
    return {f"{name} is not a number": is_finite(F.col(name)) for name in columns}


def reading_rules() -> dict[str, Column]:
    """The turbine rules: a name for the error log, and the condition a good row meets."""
    speed_low, speed_high = schemas.WIND_SPEED_RANGE
    turn_low, turn_high = schemas.WIND_DIRECTION_RANGE
    return {
        "wind_speed out of range": within(F.col("wind_speed"), speed_low, speed_high),
        "wind_direction out of range": within(F.col("wind_direction"), turn_low, turn_high),
        "power_output not above zero": above(F.col("power_output"), schemas.POWER_OUTPUT_ABOVE),
    }


def holds(condition: Column) -> Column:
    """The condition with unknown read as not met."""
    return F.coalesce(condition, F.lit(False))


def missing(columns: Sequence[str], how: str = "any") -> Column:
    """True for rows with a NULL in any, or in all, of the columns."""
    if how not in ("any", "all"):
        raise ValueError(f"how must be 'any' or 'all', not {how!r}")
    return reduce(or_ if how == "any" else and_, [F.col(name).isNull() for name in columns])


def split_nulls(
    df: DataFrame, columns: Sequence[str], how: str = "any"
) -> tuple[DataFrame, DataFrame]:
    """(complete rows, null rows); ``how="all"`` only calls a row null if every column is."""
    is_missing = missing(columns, how)
    return df.where(~is_missing), df.where(is_missing)


def split_rules(
    df: DataFrame, rules: Mapping[str, Column] | Column
) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, the others); an unknown outcome is not met."""
    conditions = [rules] if isinstance(rules, Column) else list(rules.values())
    is_valid = reduce(and_, [holds(condition) for condition in conditions])
    return df.where(is_valid), df.where(~is_valid)


def unmet(conditions: Mapping[str, Column]) -> list[Column]:
    """The name of each condition a row does not meet, NULL for the others."""
    return [F.when(~holds(condition), name) for name, condition in conditions.items()]


def reason(
    null_columns: Sequence[str],
    rules: Mapping[str, Column],
    demands: Mapping[str, Column],
    notes: Mapping[str, Column],
) -> Column:
    """Why a row is rejected, as text; empty for a good row.

    A row with gaps names its gaps; notes and rules judge complete rows only. Demands are
    made of every row.
    """
    gaps = [F.when(F.col(name).isNull(), f"{name} is null") for name in null_columns]
    return F.when(missing(null_columns), F.concat_ws("; ", *unmet(demands), *gaps)).otherwise(
        F.concat_ws("; ", *unmet({**demands, **notes, **rules}))
    )


def accepted(
    null_columns: Sequence[str], rules: Mapping[str, Column], demands: Mapping[str, Column]
) -> Column:
    """Whether a row has no gap and meets every condition; never unknown."""
    conditions = [holds(condition) for condition in (*demands.values(), *rules.values())]
    return reduce(and_, conditions, ~missing(null_columns))


def split_with_reason(
    df: DataFrame,
    null_columns: Sequence[str],
    rules: Mapping[str, Column],
    demands: Mapping[str, Column] | None = None,
    notes: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with a reason): both splits in one step.

    ``demands`` are further conditions, such as keys the target can hold; ``notes`` only add
    to the reason. Rows are told apart by the bare conditions; the text is put together for
    rejected rows only.
    """
    demands, notes = demands or {}, notes or {}
    is_good = accepted(null_columns, rules, demands)
    return df.where(is_good), df.where(~is_good).withColumn(REASON, reason(null_columns, rules, demands, notes))


def with_reason(
    df: DataFrame,
    null_columns: Sequence[str],
    rules: Mapping[str, Column],
    demands: Mapping[str, Column] | None = None,
    notes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Every row with the reason it is rejected for, NULL for accepted ones.

    The same decision as ``split_with_reason`` in one frame, for a writer that takes both kinds
    in a single pass.
    """
    demands, notes = demands or {}, notes or {}
    is_good = accepted(null_columns, rules, demands)
    return df.withColumn(REASON, F.when(~is_good, reason(null_columns, rules, demands, notes)))


def reject_log(null_rows: DataFrame, invalid_rows: DataFrame) -> DataFrame:
    """Both kinds of rejects in one frame, columns matched by name, repeats kept."""
    return null_rows.unionByName(invalid_rows)
