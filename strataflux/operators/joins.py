"""Match a source with a target on pairs of key columns.

All matches are plain equalities, so a NULL key matches nothing. No join carries a
broadcast hint: Spark broadcasts a side only when its size, estimated or measured at run
time, is below ``spark.sql.autoBroadcastJoinThreshold``, and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeyPairs = Sequence[tuple[str, str]]

# Spark's names for the kinds of joins, without underscores.
JOINS = {
    "anti": "left_anti",
    "leftanti": "left_anti",
    "semi": "left_semi",
    "leftsemi": "left_semi",
    "inner": "inner",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "full": "full",
    "outer": "full",
    "fullouter": "full",
}

# A key leaves the first step of `distinct_keys` at most this often.
KEY_SLOTS = 32


def same_keys(keys: Sequence[str]) -> list[tuple[str, str]]:
    return [(key, key) for key in keys]


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of a frame with repeats taken out before they are shuffled.

    Repeats fall away map-side and per slot, so a key that fills a third of the frame
    arrives a handful of times. The slot keeps this step apart from the join's own shuffle
    on the bare keys: with a plain shuffle on both inputs Spark can still split a source
    partition that one hot key makes too large.
    """
    slot = F.spark_partition_id() % KEY_SLOTS
    return df.select(*keys, slot.alias("__slot")).distinct().drop("__slot")


def _matches(pairs: KeyPairs, prefix: str) -> Column:
    return reduce(and_, [F.col(ours) == F.col(prefix + theirs) for ours, theirs in pairs])


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(name).alias(prefix + name) for name in df.columns])


def _padded(df: DataFrame, like: DataFrame) -> DataFrame:
    """The frame with the columns of another, NULL where it has none."""
    return df.select(
        *[
            F.col(field.name) if field.name in df.columns else F.lit(None).cast(field.dataType).alias(field.name)
            for field in like.schema
        ]
    )


def key_join(
    source: DataFrame,
    target: DataFrame,
    pairs: KeyPairs,
    how: str = "left_anti",
    prefix: str = "target_",
    target_is_keyed: bool = False,
) -> DataFrame:
    """Join on (source column, target column) pairs.

    Anti and semi joins return source columns and read only the target's keys, without
    repeats (``target_is_keyed`` says it has none). Other kinds return the source columns
    followed by the target's, prefixed. An outer join is the inner join and the rows without
    a match: of an inner join Spark can split a hot key on either side, of an outer join on
    one side at most. A left join with a keyed target is one plain join.
    """
    how = JOINS.get(how.replace("_", "").lower(), how)
    if how in ("left_anti", "left_semi"):
        keys = list(dict.fromkeys(theirs for _, theirs in pairs))
        side = target.select(*keys) if target_is_keyed else distinct_keys(target, keys)
        return source.join(_prefixed(side, prefix), _matches(pairs, prefix), how)
    # With a keyed target no source row repeats, and of a left join Spark can split a hot key of the source.
    whole = how in ("left", "full") and target_is_keyed
    joined = source.join(_prefixed(target, prefix), _matches(pairs, prefix), "left" if whole else "inner")
    result = joined
    if how in ("left", "full") and not whole:
        result = result.unionByName(_padded(unseen(source, target, pairs), joined))
    if how in ("right", "full"):
        alone = unseen(target, source, [(theirs, ours) for ours, theirs in pairs])
        result = result.unionByName(_padded(_prefixed(alone, prefix), joined))
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type {how!r}")
    return result


def unseen(source: DataFrame, target: DataFrame, pairs: KeyPairs, target_is_keyed: bool = False) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return key_join(source, target, pairs, "left_anti", target_is_keyed=target_is_keyed)


def seen(source: DataFrame, target: DataFrame, pairs: KeyPairs, target_is_keyed: bool = False) -> DataFrame:
    """Source rows whose key the target holds."""
    return key_join(source, target, pairs, "left_semi", target_is_keyed=target_is_keyed)
