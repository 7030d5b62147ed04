from __future__ import annotations

from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql.types import StructType

from strataflux import schemas
from strataflux.session import cluster_settings, scratch, shared_folder
from strataflux.sources import sinks, tables
from strataflux.sources.files import read_files, stamp_load_time, stored_bytes
from strataflux.sources.tables import Layers

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def write(folder, **files):
    Path(folder).mkdir(parents=True)
    for name, text in files.items():
        (Path(folder) / f"{name}.csv").write_text(text)


def test_empty_folder_is_an_empty_frame(spark, folder):
    write(folder)
    assert read_files(spark, folder, schema=schemas.ARRIVAL).count() == 0


def test_all_files_are_read_as_text(spark, folder):
    write(folder, a=HEADER + "2024-01-01 00:00:00,1,3.5,,\n", b=HEADER + '2024-01-02 00:00:00,01,"",7,x\n')
    for schema in (schemas.ARRIVAL, None):
        df = read_files(spark, folder, schema=schema)
        assert {f.dataType.simpleString() for f in df.schema} == {"string"}
        assert Counter(tuple(r) for r in df.collect()) == Counter(
            [("2024-01-01 00:00:00", "1", "3.5", None, None), ("2024-01-02 00:00:00", "01", None, "7", "x")]
        )


def test_another_column_order_is_refused(spark, folder):
    write(folder, a=HEADER + "t,1,2,3,4\n", b="turbine_id,timestamp,wind_speed,wind_direction,power_output\n1,t,2,3,4\n")
    with pytest.raises(Exception, match="does not conform to the schema"):
        read_files(spark, folder, schema=schemas.ARRIVAL).collect()


def test_stamp_is_one_instant_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = stamp_load_time(spark.range(1), datetime(2024, 1, 1))
        assert df.selectExpr("unix_micros(load_datetime)").first()[0] == 1704067200000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_scratch_lies_below_the_named_folder(spark):
    one, other = scratch(spark, "x"), scratch(spark, "x")
    assert one != other and one.startswith(shared_folder(spark))
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_cluster_settings_grow_with_the_data():
    small, large = cluster_settings(4000, 10**12), cluster_settings(4000, 10**14)
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(small[name]) == 8000 and int(large[name]) > 300_000


def test_missing_dataset_has_no_rows(spark, folder):
    df = tables.read_dataset(spark, folder, schemas.SILVER)
    assert df.schema.names == schemas.SILVER.names
    assert df.isEmpty()
    assert "LocalTableScan <empty>" in df._jdf.queryExecution().executedPlan().toString()


def test_whole_tables_are_never_overwritten(spark, folder):
    df = spark.range(3)
    sinks.write_new(df, folder)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_new(spark.read.parquet(folder), folder)
    with pytest.raises(ValueError):
        sinks.replace_partitions(spark.read.parquet(folder), folder, [])
    assert spark.read.parquet(folder).count() == 3


def test_partitions_read_and_replaced_in_one_go(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.replace_partitions(df, folder, ["p"])
    sinks.replace_partitions(spark.read.parquet(folder).where("p = 'a'").selectExpr("v + 10 AS v", "p"), folder, ["p"])
    assert Counter(tuple(r) for r in spark.read.parquet(folder).collect()) == Counter([(11, "a"), (2, "b")])


def test_hot_partition_is_written_by_several_tasks(spark, folder):
    """Nine rows in ten share a partition value; it must not end up in one file."""
    name, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", None
    before = spark.conf.get(name)
    spark.conf.set(name, "200k")
    try:
        df = spark.range(0, 200_000, 1, 16).selectExpr("uuid() AS v", "IF(id % 10 = 0, id % 7, 0) AS p")
        sinks.replace_partitions(df, folder, ["p"], ["v"])
    finally:
        spark.conf.set(name, before)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(folder).glob("p=*")}
    assert files["p=0"] > 8 and len(files) == 7
    assert spark.read.parquet(folder).count() == 200_000


def test_daily_files(spark, folder):
    rows = [("2024-01-01 10:00:00", "1", "2", None, "x"), ("2024-01-01 11:00:00", "2", "2", "", "y"), ("2024-01-02 00:00:00", "1", "2", "3", "z")]
    sinks.split_by_day(spark.createDataFrame(rows, schemas.ARRIVAL), folder)
    found = {p.name: list(p.glob("*.csv")) for p in Path(folder).glob("day=*")}
    assert {name: len(files) for name, files in found.items()} == {"day=2024_01_01": 1, "day=2024_01_02": 1}
    assert found["day=2024_01_02"][0].read_text() == HEADER + "2024-01-02 00:00:00,1,2,3,z\n"


def test_tables_are_created_once_and_failures_do_not_stop_the_rest(spark, folder):
    layers = Layers(folder)
    assert tables.create_layers(spark, layers, "once_") == {}
    assert tables.create_layers(spark, layers, "once_") == {}
    assert not tables.create_table(spark, "once_gold.gold_turbines", schemas.GOLD)
    failed = tables.create_tables(
        spark, {"no_such_db.t": (schemas.GOLD, None, ()), "once_gold.other": (schemas.GOLD, f"{folder}/o", ())}
    )
    assert list(failed) == ["no_such_db.t"]
    assert spark.catalog.tableExists("once_gold.other")
    columns = {c.name: c.isPartition for c in spark.catalog.listColumns("once_bronze.bronze_turbines")}
    assert [n for n, part in columns.items() if part] == ["day", "batch_id"]


def test_append_to_table_goes_by_name(spark, folder):
    tables.create_databases(spark, {"byname": folder})
    tables.create_table(spark, "byname.t", StructType.fromDDL("a INT, b INT"))
    tables.append_to_table(spark.createDataFrame([(2, 1)], "b int, a int"), "byname.t")
    assert [tuple(r) for r in spark.read.table("byname.t").collect()] == [(1, 2)]


def test_stored_bytes(spark, folder):
    spark.range(1000).repartition(3).write.parquet(folder)
    assert stored_bytes(spark, folder) == sum(p.stat().st_size for p in Path(folder).glob("*.parquet"))


class Named:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {name.replace("_", "."): value for name, value in settings.items()}

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_only_local_sessions_fall_back_to_this_machine():
    assert shared_folder(Named(spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    assert Path(shared_folder(Named(spark_master="local[2]"))).is_dir()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Named(spark_master="yarn"))
