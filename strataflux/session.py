"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

ZONE_SETTING = "spark.sql.session.timeZone"

# What a session should run with. AQE sizes shuffle reads, splits skewed join and
# rebalance partitions and turns joins with a measured small side into broadcasts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # A join side is broadcast at run time only if its measured rows take no more than this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    ZONE_SETTING: "UTC",
}


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_settings(cores: int, largest_shuffle_bytes: int) -> dict[str, str]:
    """Settings for a cluster, given its cores and the bytes of its largest shuffle.

    AQE merges shuffle partitions that turn out small but cannot cut those of an
    aggregation, so there must be enough of them for the largest input from the start.
    """
    needed = -(-largest_shuffle_bytes // SHUFFLE_PARTITION_BYTES)
    partitions = str(max(2 * cores, needed))
    return {**SETTINGS, "spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions}


@contextmanager
def session_zone(spark: SparkSession, zone: str) -> Iterator[None]:
    """Analyse everything inside the block in one time zone, whatever the session uses.

    Zone-less text becomes an instant and an instant becomes a day in this zone, so both
    must use the same one.
    """
    before = spark.conf.get(ZONE_SETTING)
    spark.conf.set(ZONE_SETTING, zone)
    try:
        yield
    finally:
        spark.conf.set(ZONE_SETTING, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _folder_of_this_machine()


@cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="strataflux-")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/strataflux/{label}-{uuid.uuid4().hex}"
