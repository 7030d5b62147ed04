"""Arriving files."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflux import schemas
from strataflux.functions.times import utc


def csv_options(has_header: bool, schema: StructType | None) -> dict[str, str]:
    """With a schema and a header, Spark checks every file's header against the schema.

    Without that check columns are taken by position, so a file with another column order
    would be read wrongly and silently.
    """
    options = {"header": str(has_header).lower()}
    if schema is not None and has_header:
        options["enforceSchema"] = "false"
    return options


def read_files(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "csv",
    has_header: bool = True,
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Every file of a folder in any format Spark reads, without type inference for CSV.

    A schema makes an empty folder an empty frame and saves the pass that finds the names.
    """
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.options(**csv_options(has_header, schema))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def reading_files(schema: StructType, file_format: str = "csv") -> tuple[StructType, dict[str, str]]:
    """Schema and options that keep the line of a CSV row with other fields than declared.

    Without them Spark drops surplus fields without a word.
    """
    if file_format != "csv":
        return schema, {}
    name = schemas.MALFORMED_LINE.name
    return StructType([*schema.fields, schemas.MALFORMED_LINE]), {"columnNameOfCorruptRecord": name}


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the path of the file each row was read from."""
    return df.select("*", F.col("_metadata.file_path").alias(schemas.SOURCE_FILE.name))


def move_files(spark: SparkSession, files: list[str], below: str, to: str) -> None:
    """Move files to the same places below another folder; those moved already are passed over."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    new_path = jvm.org.apache.hadoop.fs.Path
    root = new_path(below)
    system = root.getFileSystem(context.hadoopConfiguration())
    root_text = system.makeQualified(root).toUri().getPath()

    def move(file: str) -> None:
        source = new_path(jvm.java.net.URI(file))
        inside = source.toUri().getPath().removeprefix(root_text).lstrip("/")
        target = new_path(new_path(to), inside)
        if not system.exists(source) and system.exists(target):
            return
        system.mkdirs(target.getParent())
        if not system.rename(source, target):
            raise OSError(f"{file} could not be moved to {target.toString()}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, files))


def stamp_load_time(df: DataFrame, moment: datetime, column: str = "load_datetime") -> DataFrame:
    """Give every row the one load time of its batch."""
    return df.withColumn(column, F.lit(utc(moment)).cast("timestamp"))


def stored_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Path and length of every file below a path; contents are not read."""
    listing = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=pattern)
    return listing.load(path).select("path", "length")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path, as the file system tells them; no task lists files."""
    jvm, context = spark.sparkContext._jvm, spark.sparkContext._jsc
    root = jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(context.hadoopConfiguration()).getContentSummary(root).getLength()
