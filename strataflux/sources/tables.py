"""Layer tables at rest: Parquet datasets addressed by path, optionally named in the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from strataflux import schemas


# Names of the layer tables in the catalog, after the prefix of their set.
BRONZE_NAME = "bronze.bronze_turbines"
SILVER_NAME = "silver.silver_turbines"
ERROR_LOG_NAME = "silver.error_log"
GOLD_NAME = "gold.gold_turbines"

# What Spark names the folder of a missing partition value.
MISSING = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Layers:
    """Where one set of layers lives. Every path must be visible to all executors."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> str:
        return self._at("raw", "landing")

    @property
    def processed(self) -> str:
        return self._at("raw", "processed")

    @property
    def bronze(self) -> str:
        return self._at("bronze", "bronze_turbines")

    @property
    def silver(self) -> str:
        return self._at("silver", "silver_turbines")

    @property
    def error_log(self) -> str:
        return self._at("silver", "error_log")

    @property
    def gold(self) -> str:
        return self._at("gold", "gold_turbines")

    @property
    def batch_log(self) -> str:
        return self._at("state", "batch_log")

    @property
    def touched_days(self) -> str:
        return self._at("state", "touched_days")

    @property
    def moments(self) -> str:
        return self._at("state", "moments")

    @property
    def landed_files(self) -> str:
        return self._at("state", "landed_files")

    @property
    def silver_runs(self) -> str:
        return self._at("state", "silver_runs")

    @property
    def arrived_files(self) -> str:
        return self._at("state", "arrived_files")

    @property
    def arrivals_checkpoint(self) -> str:
        return self._at("state", "arrivals")

    def staging(self, stage: str) -> str:
        return self._at("state", "staging", stage)


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame the optimizer knows to be empty, so joins with it fold away."""
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(0).select(*nothing).where(F.lit(False))


def read_dataset(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet dataset with a known schema; one not written yet has no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def partition_folders(spark: SparkSession, path: str, column: str, values: Sequence | None = None) -> list[str]:
    """Folders of first-level partitions, of these values or of all; no file is listed.

    None stands for the partition of missing values.
    """
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    root = jvm.org.apache.hadoop.fs.Path(path)
    named = "*" if values is None else ",".join(MISSING if value is None else str(value) for value in values)
    pattern = jvm.org.apache.hadoop.fs.Path(root, f"{column}={{{named}}}" if values is not None else f"{column}=*")
    found = root.getFileSystem(context.hadoopConfiguration()).globStatus(pattern)
    return [status.getPath().toString() for status in found or []]


def read_partitions(
    spark: SparkSession, path: str, schema: StructType, column: str, values: Sequence
) -> DataFrame:
    """The rows of some first-level partitions; the files of no other one are listed.

    The values are dates, or other texts without the characters partition names escape.
    """
    folders = partition_folders(spark, path, column, values) if values else []
    if not folders:
        return no_rows(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def quoted_name(name: str) -> str:
    """A name, its parts separated by dots, as an identifier in SQL text."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def quoted_text(text: str) -> str:
    """A text as a literal in SQL text."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_databases(spark: SparkSession, locations: Mapping[str, str]) -> None:
    """Create each database at its location unless it is there."""
    for name, location in locations.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name(name)} LOCATION {quoted_text(location)}")


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    location: str | None = None,
    partitions: Sequence[StructField] = (),
) -> bool:
    """Create a Parquet table unless it exists; True when it was created."""
    if spark.catalog.tableExists(name):
        return False
    stored = schemas.stored(schema, list(partitions))
    names = ", ".join(quoted_name(field.name) for field in partitions)
    parts = f" PARTITIONED BY ({names})" if partitions else ""
    place = f" LOCATION {quoted_text(location)}" if location is not None else ""
    spark.sql(f"CREATE TABLE {quoted_name(name)} ({stored.toDDL()}) USING parquet{parts}{place}")
    return True


def create_tables(
    spark: SparkSession,
    tables: Mapping[str, tuple[StructType, str | None, Sequence[StructField]]],
) -> dict[str, Exception]:
    """Create several tables; one that fails does not stop the others and is returned."""
    failed: dict[str, Exception] = {}
    for name, (schema, location, partitions) in tables.items():
        try:
            create_table(spark, name, schema, location, partitions)
        except Exception as error:  # noqa: BLE001 - reported to the caller
            failed[name] = error
    return failed


def create_layers(spark: SparkSession, layers: Layers, prefix: str = "") -> dict[str, Exception]:
    """Databases and tables of all layers over the paths the jobs write.

    ``prefix`` keeps several sets apart in one catalog.
    """
    create_databases(
        spark, {prefix + name: f"{layers.root.rstrip('/')}/{name}" for name in schemas.DATABASES}
    )
    return create_tables(
        spark,
        {
            prefix + BRONZE_NAME: (schemas.BRONZE, layers.bronze, schemas.BRONZE_PARTITIONS),
            prefix + SILVER_NAME: (schemas.SILVER, layers.silver, schemas.DAILY_PARTITIONS),
            prefix + ERROR_LOG_NAME: (schemas.ERROR_LOG, layers.error_log, schemas.ERROR_LOG_PARTITIONS),
            prefix + GOLD_NAME: (schemas.GOLD, layers.gold, schemas.DAILY_PARTITIONS),
        },
    )


def register_new_partitions(spark: SparkSession, names: Sequence[str]) -> None:
    """Let the catalog see partitions that jobs wrote by path."""
    for name in names:
        spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)


def add_partitions(
    spark: SparkSession, name: str, path: str, column: str, values: Sequence | None
) -> list[str]:
    """Let the catalog see these first-level partitions, or all; no file is listed.

    Only those that have a folder are added; returns their specifications. Adding one again changes nothing.
    """
    found = [] if values is not None and not values else partition_folders(spark, path, column, values)
    folders = [folder.rpartition("/")[2] for folder in found]
    specs = [f"PARTITION ({quoted_name(column)} = {quoted_text(folder.partition('=')[2])})" for folder in folders]
    if specs:
        spark.sql(f"ALTER TABLE {quoted_name(name)} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(name)
    return specs


def append_to_table(df: DataFrame, name: str) -> None:
    """Append rows to a catalog table, columns matched by name."""
    partitions = [column.name for column in df.sparkSession.catalog.listColumns(name) if column.isPartition]
    df.write.mode("append").partitionBy(*partitions).saveAsTable(name)
