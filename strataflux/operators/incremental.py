"""Limit a run to what is new."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.schemas import FIRST_MARK


def high_water_mark(df: DataFrame, column: str, default: datetime = FIRST_MARK) -> DataFrame:
    """One row: the greatest value of the column, or the default when there is none."""
    kind = df.schema[column].dataType
    return df.agg(F.coalesce(F.max(column), F.lit(default).cast(kind)).alias(column))


def newer_than(
    source: DataFrame, target: DataFrame, column: str, default: datetime = FIRST_MARK
) -> DataFrame:
    """Source rows past the target's mark.

    The mark is one value, computed first by its own small aggregate and compared in the
    scan of the source.
    """
    mark = high_water_mark(target, column, default).select(
        F.col(column).cast(source.schema[column].dataType)
    )
    return source.where(F.col(column) > mark.scalar())


def touched_groups(
    source: DataFrame, group_columns: Sequence[str], column: str, since: datetime
) -> DataFrame:
    """Groups holding a row newer than the mark, each once.

    Rows are reduced to their groups before the shuffle, so its size follows the groups.
    """
    return source.where(F.col(column) > F.lit(since)).select(*group_columns).distinct()
