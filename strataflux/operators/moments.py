"""Counts, means and squared deviations per group that can be put together without their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

MOMENTS = StructType(
    [
        StructField("readings", LongType()),
        StructField("mean", DoubleType()),
        StructField("squares", DoubleType()),
        StructField("low", DoubleType()),
        StructField("high", DoubleType()),
    ]
)


def moments(df: DataFrame, group_columns: Sequence[str], value_column: str) -> DataFrame:
    """One row per group: known values, their mean, sum of squared deviations from it, least and greatest.

    A group of NULL values alone has no readings and NULL besides. Partial results merge in every
    task, so one row per group and task is shuffled.
    """
    value = F.col(value_column).cast("double")
    return df.groupBy(*group_columns).agg(
        F.count(value).alias("readings"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("squares"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def combined_moments(parts: DataFrame, group_columns: Sequence[str]) -> DataFrame:
    """The moments of whole groups from those of their parts.

    Squared deviations are moved from each part's mean to the common one, which loses no digits where
    means are large beside deviations. One shuffle by group serves both steps.
    """
    group = Window.partitionBy(*group_columns)
    weighed = F.sum(F.col("mean") * F.col("readings")).over(group)
    centre = F.try_divide(weighed, F.sum("readings").over(group).cast("double"))
    moved = F.col("squares") + F.col("readings") * F.pow(F.col("mean") - F.col("__centre"), F.lit(2))
    return (
        parts.withColumn("__centre", centre)
        .groupBy(*group_columns)
        .agg(
            F.sum("readings").alias("readings"),
            F.max("__centre").alias("mean"),
            F.sum(moved).alias("squares"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )


def deviation() -> Column:
    """The sample standard deviation; NULL for fewer than two readings."""
    spare = F.when(F.col("readings") > 1, F.col("readings") - 1)
    return F.sqrt(F.col("squares") / spare)
