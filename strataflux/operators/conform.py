"""Fit a frame to a declared schema, and check what the schema demands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflux.functions.numbers import conform


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast columns the schema names, in one projection.

    Columns the frame lacks are not added; columns the schema lacks pass through.
    """
    wanted = {field.name: field.dataType for field in schema}

    def projected(name: str) -> Column:
        if name not in wanted:
            return F.col(name)
        return conform(F.col(name), df.schema[name].dataType, wanted[name]).alias(name)

    return df.select(*[projected(name) for name in df.columns])


def required_columns(df: DataFrame, schema: StructType) -> list[str]:
    return [field.name for field in schema if not field.nullable and field.name in df.columns]


def not_null_violations(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per NOT NULL column of the schema with its number of NULLs, in one pass."""
    required = required_columns(df, schema)
    if not required:
        return df.sparkSession.createDataFrame([], "column_name string, violations bigint")
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    lines = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("violations")) for name in required]
    )
    return counts.select(F.inline(lines))
