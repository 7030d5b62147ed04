"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflux.session import scratch

# The space characters of the text contracts, as a regular-expression class body.
SPACE_CLASS = r"\x20\x09-\x0D"


def workers_find_package(spark: SparkSession) -> None:
    """Put this package on the path of Python workers that see the same files as the driver.

    Elsewhere the package is shipped with the job (``--py-files``).
    """
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])


# What workers keep from task to task; each is a cached function.
KEPT: list[Callable] = []


def give_back() -> None:
    """At the start of a task: let go of what this worker has kept for other operators, and of freed memory.

    Workers are used again by the tasks that follow, so what one operator keeps would count against all.
    """
    for kept in KEPT:
        kept.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Write rows below the shared folder and read them back, which cuts the lineage."""
    spark = rows.sparkSession
    path = scratch(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


class Workspace:
    """Tables of one run below a folder of their own in the shared folder."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.path, self.count = spark, scratch(spark, label), 0

    def folder(self) -> str:
        self.count += 1
        return f"{self.path}/{self.count}"

    def staged(self, rows: DataFrame) -> DataFrame:
        """Write rows and read them back, which cuts the lineage."""
        path = self.folder()
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, label: str) -> Iterator[Workspace]:
    """A workspace that is removed when its block ends well; a failed run leaves it to be looked at."""
    found = Workspace(spark, label)
    yield found
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    path = jvm.org.apache.hadoop.fs.Path(found.path)
    path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside the block."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
