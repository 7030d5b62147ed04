"""Writers for Parquet datasets and daily files.

None of them ever overwrites a dataset as a whole: Spark clears the target before it has
read everything, so overwriting an input that way loses it. A table changes by appending,
or by replacing the partitions a frame holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.functions.times import day_label
from strataflux.operators.layout import even_out


def append_rows(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), folders: int = 0
) -> None:
    """Add rows in well-sized files; ``folders`` as for ``even_out``."""
    even_out(df, partition_by, sort_by, folders).write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    spread: str = "by partition",
    folders: int = 0,
) -> None:
    """Swap in the partitions the frame holds and leave all others alone.

    Spark writes the new files beside the table and moves them in when every task is done,
    so the frame may read the very partitions it replaces. Writing the same rows again
    gives the same table. ``spread`` says how rows reach the writers: ``"by partition"``
    gathers many partition values into few files each, ``"evenly"`` suits few values, and
    ``"as is"`` saves the shuffle where the frame is spread well already. ``folders`` as
    for ``even_out``.
    """
    if not partition_by:
        raise ValueError("replacing partitions needs partition columns; a whole table is never overwritten")
    order = [*partition_by, *[name for name in sort_by if name not in partition_by]]
    if spread == "as is":
        rows = df.sortWithinPartitions(*order)
    else:
        rows = even_out(df, partition_by if spread == "by partition" else (), order, folders)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def remove_partitions(spark: SparkSession, path: str, name: str, value: str) -> None:
    """Remove the partitions with one value of a column, at any depth, if there are any.

    A batch that is loaded again may have rows in other partitions than the first time.
    """
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(context.hadoopConfiguration())
    for pattern in (f"{name}={value}", f"*=*/{name}={value}"):
        for found in system.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []:
            system.delete(found.getPath(), True)


def write_new(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a dataset to a path that must not exist yet."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)


def stage(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    sort_by: Sequence[str] = (),
    spread: str = "by partition",
    folders: int = 0,
) -> None:
    """Fill a job's own staging path, dropping what an earlier run left there.

    ``spread="as is"`` saves the shuffle where there are few partition values. ``folders`` as for ``even_out``.
    """
    rows = df if spread == "as is" else even_out(df, partition_by, sort_by, folders)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def split_by_day(
    df: DataFrame, path: str, time_column: str = "timestamp", label_column: str = "day"
) -> None:
    """CSV files with a header, one folder per calendar day named ``day=yyyy_MM_dd``.

    The day leaves the file body. A day of ordinary size is one file; one above the advised
    partition size is cut into several. Rows whose time cannot be read come under the folder
    Spark has for missing values.
    """
    labelled = df.withColumn(label_column, day_label(F.col(time_column).try_cast("timestamp")))
    (
        even_out(labelled, [label_column])
        .write.mode("errorifexists")
        .option("header", "true")
        .partitionBy(label_column)
        .csv(path)
    )
