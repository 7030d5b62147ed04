"""A registry of landed files by content: a file that is sent again is told from a new or a changed one.

Names and times do not tell: a sender that repeats a file may give it another name and always gives
it another time, and a corrected file often keeps its name.
"""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strataflux import schemas
from strataflux.sources.sinks import replace_partitions
from strataflux.sources.tables import read_dataset

BATCH = schemas.BATCH_PARTITION
NEW, CHANGED, REDELIVERED = "new", "changed", "redelivered"
LANDED = StructType(
    [
        StructField("path", StringType()),
        StructField("n_lines", LongType()),
        StructField("n_bytes", LongType()),
        StructField("digest", StringType()),
        StructField("kind", StringType()),
        BATCH,
    ]
)
NO_LINES = (0, 0, "0-0")


def plain_path(uri: str) -> str:
    return unquote(urlparse(uri).path)


def contents(spark: SparkSession, files: list[str]) -> dict[str, tuple[int, int, str]]:
    """Lines, bytes and digest of every file by its plain path, in one distributed pass.

    The digest is a sum and an exclusive or of hashes of the lines, so tasks that read parts of a file
    add up, and files with the same lines in another order count as equal. One row per file
    comes to the driver, which lists the files of a batch as it is.
    """
    if not files:
        return {}
    lines = spark.read.text([unquote(file) for file in files])
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    total = F.sum(F.xxhash64("value").cast("decimal(20,0)")).cast("string")
    mixed = F.bit_xor(F.xxhash64(F.lit(1), F.col("value"))).cast("string")
    found = lines.groupBy("path").agg(
        F.count(F.lit(1)), F.sum(F.octet_length("value")), F.concat_ws("-", total, mixed)
    )
    by_path = {plain_path(path): (count, size, digest) for path, count, size, digest in found.collect()}
    return {plain_path(file): by_path.get(plain_path(file), NO_LINES) for file in files}


def register_files(spark: SparkSession, registry: str, files: list[str], below: str, batch: str) -> list[str]:
    """Note the files of a batch with their kind and return those to be loaded: all but redelivered ones.

    A file is ``redelivered`` if an earlier batch, or a file of this one that comes before it by path,
    has the same content under whatever name; ``changed`` if an earlier batch had another file
    at its place below the landing folder; else ``new``. Files without a line never count as
    redelivered. Registering a batch again replaces its notes and gives the same answer.
    """
    root = plain_path(below).rstrip("/") + "/"
    seen = contents(spark, files)
    rows = []
    for path, (count, size, digest) in sorted(seen.items()):
        rows.append((path.removeprefix(root), count, size, digest, None, batch))
    if not rows:
        return []
    landed = spark.createDataFrame(rows, LANDED)
    earlier = read_dataset(spark, registry, LANDED).where(F.col(BATCH.name) < batch)
    same = earlier.join(landed.select("digest", "n_bytes").distinct(), ["digest", "n_bytes"], "left_semi")
    known = {tuple(row) for row in same.select("digest", "n_bytes").distinct().collect()}
    placed = earlier.join(landed.select("path"), "path", "left_semi").select("path").distinct()
    places = {row[0] for row in placed.collect()}
    judged, taken = [], set()
    for path, count, size, digest, _, _ in rows:
        repeated = count > 0 and (digest, size) in known
        kind = REDELIVERED if repeated else CHANGED if path in places else NEW
        known.add((digest, size))
        judged.append((path, count, size, digest, kind, batch))
        if not repeated:
            taken.add(root + path if not path.startswith("/") else path)
    replace_partitions(spark.createDataFrame(judged, LANDED), registry, [BATCH.name], spread="as is")
    return [file for file in files if plain_path(file) in taken]


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    """Every file that was registered, with its kind and batch."""
    return read_dataset(spark, registry, LANDED)
