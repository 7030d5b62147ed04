"""Daily statistics with an anomaly flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux import schemas
from strataflux.functions.numbers import rounded
from strataflux.operators.moments import deviation


def daily_summary(
    df: DataFrame,
    group_columns: Sequence[str] = tuple(schemas.SUMMARY_KEYS),
    value_column: str = "power_output",
    deviations: float = schemas.ANOMALY_DEVIATIONS,
) -> DataFrame:
    """Average, minimum and maximum per group, flagged when an extreme lies too far out.

    The bounds are the rounded average plus and minus the given number of sample standard
    deviations; a single reading has no deviation and is never flagged. All aggregates merge
    partial results, so only one row per group and task is shuffled however large a group is.
    """
    average, low, high = (f"{kind}_{value_column}" for kind in ("avg", "min", "max"))
    grouped = df.groupBy(*group_columns).agg(
        rounded(F.avg(value_column), schemas.AVERAGE_DECIMALS).alias(average),
        F.min(value_column).alias(low),
        F.max(value_column).alias(high),
        F.stddev_samp(value_column).alias("__deviation"),
    )
    return flagged(grouped, group_columns, (average, low, high), deviations)


def flagged(
    grouped: DataFrame, group_columns: Sequence[str], extremes: Sequence[str], deviations: float
) -> DataFrame:
    """Groups with average, minimum and maximum, and whether one of these lies too far out."""
    average, low, high = extremes
    reach = F.lit(deviations) * F.col("__deviation")
    outside = (F.col(high) > F.col(average) + reach) | (F.col(low) < F.col(average) - reach)
    return grouped.select(
        *group_columns, average, low, high, F.coalesce(outside, F.lit(False)).alias("is_anomaly")
    )


def summary_of_moments(
    known: DataFrame,
    group_columns: Sequence[str] = tuple(schemas.SUMMARY_KEYS),
    value_column: str = "power_output",
    deviations: float = schemas.ANOMALY_DEVIATIONS,
) -> DataFrame:
    """As ``daily_summary``, from the moments of the groups in place of their rows."""
    average, low, high = (f"{kind}_{value_column}" for kind in ("avg", "min", "max"))
    grouped = known.select(
        *group_columns,
        rounded(F.col("mean"), schemas.AVERAGE_DECIMALS).alias(average),
        F.col("low").alias(low),
        F.col("high").alias(high),
        deviation().alias("__deviation"),
    )
    return flagged(grouped, group_columns, (average, low, high), deviations)
