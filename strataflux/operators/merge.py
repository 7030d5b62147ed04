"""Merges composed of joins and unions; each returns rows, a sink decides where they go.

Inputs of a merge are shuffled once, on the keys. When one side is small Spark broadcasts
it instead and the large side is not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflux.operators.joins import same_keys, unseen

MATCHED = "__matched"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``newest_by``, then by the other columns in order.

    A maximum over a struct, not a ranking window: every task first reduces its own rows to
    one per key, so a key that fills a third of the input never gathers in one task.
    """
    rest = [name for name in df.columns if name not in keys and name not in newest_by]
    order = [*newest_by, *rest]
    if not order:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__best"))
    return best.select(
        *[F.col(name) if name in keys else F.col(f"__best.{name}").alias(name) for name in df.columns]
    )


def absent_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], target_is_keyed: bool = False
) -> DataFrame:
    """What an insert-only merge adds: source rows with a key new to the target, repeats kept."""
    return unseen(source, target, same_keys(keys), target_is_keyed)


def merge_insert_only(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after an insert-only merge; its own rows stay as they are."""
    return target.unionByName(absent_rows(source, target, keys))


def upsert(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    newest_by: Sequence[str] = (),
    source_is_keyed: bool = False,
) -> DataFrame:
    """The target after replacing rows the source has a key for and adding the others.

    The target holds one row per key. Several source rows for a key are reduced to the
    latest. The join sees no more of the source than its keys, so corrections that are few
    are broadcast and the target is read in place; a full outer join, the other way to write
    this, would shuffle the target always.
    """
    incoming = source if source_is_keyed else latest_per_key(source, keys, newest_by)
    untouched = unseen(target, incoming, same_keys(keys), target_is_keyed=True)
    return untouched.unionByName(incoming.select(*target.columns))


def merge_update_insert(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """The target after a merge that sets the chosen columns on a match and inserts the rest.

    ``None`` sets every column. Setting keys alone changes nothing, so the merge then only
    inserts.
    """
    if update_columns is None:
        return upsert(source, target, keys, newest_by)
    settable = [name for name in update_columns if name not in keys]
    incoming = latest_per_key(source, keys, newest_by).select(*target.columns)
    if not settable:
        return target.unionByName(unseen(incoming, target, same_keys(keys)))
    values = incoming.select(
        *[F.col(key).alias(f"__{key}") for key in keys],
        *[F.col(name).alias(f"__{name}") for name in settable],
        F.lit(True).alias(MATCHED),
    )
    on_keys = [F.col(key) == F.col(f"__{key}") for key in keys]
    updated = target.join(values, on_keys, "left").select(
        *[
            F.when(F.col(MATCHED), F.col(f"__{name}")).otherwise(F.col(name)).alias(name)
            if name in settable
            else F.col(name)
            for name in target.columns
        ]
    )
    return updated.unionByName(unseen(incoming, target, same_keys(keys)))
