from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from strataflux.session import SETTINGS, scratch  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def new_session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("strataflux-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return new_session()


@pytest.fixture
def folder(spark: SparkSession, request) -> str:
    """A new folder for one test."""
    return scratch(spark, request.node.name.split("[")[0])
