"""How rows are spread over files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_by_keys(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Cut the rows into key ranges, sorted inside, so files have narrow key bounds.

    A running row number closes the sort key: equal keys, even identical rows, can fall on
    both sides of a cut, so a hot key fills as many partitions as it needs.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    return (
        numbered.repartitionByRange(partitions, *keys, "__row")
        .sortWithinPartitions(*keys)
        .drop("__row")
    )


# Ranges each column is cut into, as a power of two, and rows looked at to find them.
RANGE_BITS, SAMPLED = 6, 20_000


def range_number(df: DataFrame, column: str) -> Column:
    """In which of about equally full ranges of its column a value lies; 0 for NULL.

    The bounds come from a bounded sample. They decide where rows lie, never which rows there are.
    """
    known = df.select(column).where(F.col(column).isNotNull())
    share = min(1.0, SAMPLED / max(1, known.count()))
    sample = sorted(row[0] for row in known.sample(share, 7).collect())
    cuts = 1 << RANGE_BITS
    bounds = sorted({sample[len(sample) * k // cuts] for k in range(1, cuts)}) if sample else []
    typed = [F.lit(bound).cast(df.schema[column].dataType) for bound in bounds]
    return sum([F.coalesce((F.col(column) >= bound).cast("int"), F.lit(0)) for bound in typed], F.lit(0))


def interleaved(df: DataFrame, keys: Sequence[str], partitions: int, together: Sequence[str] = ()) -> DataFrame:
    """Cut the rows so that files have narrow bounds in every key, not in the first alone.

    The bits of the keys' range numbers are taken in turn (a Z-order curve), and rows are cut by
    the number these make, inside the values of ``together``. Equal keys can fall on both sides of a cut.
    """
    numbers = [f"__range_{k}" for k in range(len(keys))]
    ranged = df.withColumns({name: range_number(df, key) for name, key in zip(numbers, keys, strict=True)})
    curve = F.lit(0).cast("bigint")
    for bit in range(RANGE_BITS):
        for k, name in enumerate(numbers):
            own = F.shiftright(name, bit).bitwiseAND(1).cast("bigint")
            curve = curve + F.shiftleft(own, bit * len(keys) + len(keys) - 1 - k)
    placed = ranged.withColumn("__curve", curve).withColumn("__row", F.monotonically_increasing_id())
    cut = placed.repartitionByRange(partitions, *together, "__curve", "__row")
    return cut.sortWithinPartitions(*together, "__curve", *keys).drop(*numbers, "__curve", "__row")


# A task fills at most about so many folders one after another where their number is known.
FOLDERS_AT_ONCE = 16


def even_out(
    df: DataFrame, together: Sequence[str] = (), sort_by: Sequence[str] = (), folders: int = 0
) -> DataFrame:
    """Gather rows of one partition value into few files of the advised size.

    A rebalance, not a repartition: at run time Spark merges small partitions and splits
    those above ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a day that holds a
    third of the rows is written by many tasks.

    ``folders`` is the number of partition values of rows that are few in each, such as one per group.
    By their bytes alone one task would get them all and write a folder after the other; many
    of them are dealt out by number.
    """
    if together and folders > FOLDERS_AT_ONCE:
        spread = df.repartition(-(-folders // FOLDERS_AT_ONCE), *together)
    else:
        spread = df.hint("rebalance", *together)
    order = [*together, *[name for name in sort_by if name not in together]]
    return spread.sortWithinPartitions(*order) if order else spread
