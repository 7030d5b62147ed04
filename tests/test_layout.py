from __future__ import annotations

from collections import Counter
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strataflux.functions.times import batch_name
from strataflux.operators.layout import order_by_keys
from strataflux.plans import upkeep
from strataflux.plans.file_swap import FileSwap
from strataflux.plans.swap import gold_table
from strataflux.session import scratch
from strataflux.sources import sinks
from strataflux.sources.tables import Layers
from workloads.data import load_moment

STORED = StructType([StructField("v", LongType()), StructField("p", StringType())])


def file_ranges(df, column):
    bounds = df.groupBy(F.input_file_name()).agg(F.min(column), F.max(column), F.count("*"))
    return sorted((low, high, n) for _, low, high, n in bounds.collect())


def test_files_hold_narrow_key_ranges(spark, folder):
    source = f"{SMALL}/lineitem.parquet"
    upkeep.recluster(spark, source, folder, ["l_orderkey", "l_linenumber"], file_bytes=16 * 1024)
    ranges = file_ranges(spark.read.parquet(folder), "l_orderkey")
    assert len(ranges) > 4
    assert all(before[1] <= after[0] for before, after in zip(ranges, ranges[1:]))
    assert spark.read.parquet(folder).exceptAll(spark.read.parquet(source)).count() == 0
    assert spark.read.parquet(folder).count() == spark.read.parquet(source).count()


def test_hot_key_is_cut_across_files(spark, folder):
    """Identical rows make up most of the table and still spread over the partitions."""
    df = spark.range(0, 60_000, 1, 6).selectExpr("IF(id % 3 = 0, id, 7) AS k", "'same' AS v")
    order_by_keys(df, ["k"], 12).write.parquet(folder)
    sizes = [n for _, _, n in file_ranges(spark.read.parquet(folder), "k")]
    assert len(sizes) >= 11 and max(sizes) < 2 * 60_000 / 12


def fragment(spark, path):
    for part in range(4):
        sinks.append_rows(spark.range(part * 100, part * 100 + 100).selectExpr("id AS v", "'a b/c' AS p"), path, ["p"])
    sinks.append_rows(spark.range(5).selectExpr("id AS v", "'whole' AS p"), path, ["p"])


def contents(spark, path):
    return Counter(tuple(r) for r in spark.read.schema(STORED).parquet(path).collect())


def test_compaction_touches_fragmented_partitions_only(spark, folder):
    path, state = f"{folder}/t", f"{folder}/state"
    fragment(spark, path)
    before = contents(spark, path)
    whole = [p.name for p in Path(path).glob("p=whole/*.parquet")]
    assert upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-1") == ["a b/c"]
    assert contents(spark, path) == before
    assert [p.name for p in Path(path).glob("p=whole/*.parquet")] == whole
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in Path(path).glob("p=*"))
    assert upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-2") == []


def break_off(monkeypatch, run, moves=0):
    """Let the run break off after it has moved so many files in."""
    real, left = FileSwap._move, [moves]

    def lost(self, *args):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("lost")
        real(self, *args)

    with monkeypatch.context() as patch:
        patch.setattr(FileSwap, "_move", lost)
        with pytest.raises(RuntimeError):
            run()


@pytest.mark.parametrize("moves", [0, 1])
def test_compaction_survives_a_crash_while_moving_in(spark, folder, monkeypatch, moves):
    path, state = f"{folder}/t", f"{folder}/state"
    fragment(spark, path)
    for part in range(4):
        sinks.append_rows(spark.range(50).selectExpr("id AS v", "'more' AS p"), path, ["p"])
    before = contents(spark, path)
    break_off(monkeypatch, lambda: upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-1"), moves)
    upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-2")
    assert contents(spark, path) == before
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in Path(path).glob("p=*"))


def test_rows_appended_after_a_broken_compaction_stay(spark, folder, monkeypatch):
    path, state = f"{folder}/t", f"{folder}/state"
    fragment(spark, path)
    break_off(monkeypatch, lambda: upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-1"))
    for part in range(4):
        sinks.append_rows(spark.range(900, 940).selectExpr("id AS v", "'a b/c' AS p"), path, ["p"])
    wanted = contents(spark, path)
    assert upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-2") == ["a b/c"]
    assert contents(spark, path) == wanted


def test_rows_replaced_after_a_broken_compaction_stay(spark, folder, monkeypatch):
    path, state = f"{folder}/t", f"{folder}/state"
    fragment(spark, path)
    break_off(monkeypatch, lambda: upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-1"))
    sinks.replace_partitions(spark.range(7, 9).selectExpr("id AS v", "'a b/c' AS p"), path, ["p"])
    wanted = contents(spark, path)
    assert upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-2") == []
    assert contents(spark, path) == wanted


def test_rows_that_arrive_while_staging_stay(spark, folder, monkeypatch):
    path, state = f"{folder}/t", f"{folder}/state"
    fragment(spark, path)
    real = upkeep.stage

    def slow(rows, *args):
        sinks.append_rows(spark.range(900, 940).selectExpr("id AS v", "'a b/c' AS p"), path, ["p"])
        real(rows, *args)

    wanted = contents(spark, path)
    wanted.update((v, "a b/c") for v in range(900, 940))
    with monkeypatch.context() as patch:
        patch.setattr(upkeep, "stage", slow)
        upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-1")
    assert contents(spark, path) == wanted


def test_everything_is_clustered_on_both_columns(spark, folder):
    rows = spark.range(40_000).selectExpr("xxhash64(id) % 1000 AS a", "CAST(xxhash64(id, 1) % 1000 AS STRING) AS b", "id % 2 AS p")
    rows.repartition(3).write.partitionBy("p").parquet(f"{folder}/t")
    stored = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("p", LongType())])
    done = upkeep.compact(
        spark, f"{folder}/t", stored, ["p"], ["a", "b"], f"{folder}/state", "run-1", 16 * 1024, True, True
    )
    assert done == [("0",), ("1",)]
    found = spark.read.schema(stored).parquet(f"{folder}/t")
    assert found.exceptAll(rows.select("a", "b", "p")).count() == 0 and found.count() == 40_000
    ranges = found.groupBy(F.input_file_name()).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).collect()
    assert len(ranges) >= 8
    assert sum(low <= 500 <= high for _, low, high, *_ in ranges) <= 0.75 * len(ranges)
    assert sum(low <= "500" <= high for *_, low, high in ranges) <= 0.75 * len(ranges)


def test_runs_must_come_in_order(spark, folder, monkeypatch):
    """As text, run-10 would sort before run-9 and its crash would go unseen: it is refused."""
    path, state = f"{folder}/t", f"{folder}/state"
    fragment(spark, path)
    before = contents(spark, path)
    upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-9")
    fragment(spark, path)
    with pytest.raises(ValueError, match="come after"):
        upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-10")
    with pytest.raises(ValueError, match="come after"):
        upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-9")
    break_off(monkeypatch, lambda: upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-910"))
    upkeep.compact(spark, path, STORED, "p", ["v"], state, "run-911")
    assert contents(spark, path) == before + before


def test_missing_and_nested_partitions(spark, folder):
    path, state = f"{folder}/t", f"{folder}/state"
    stored = StructType([STORED["v"], StructField("p", StringType()), StructField("q", LongType())])
    for part in range(3):
        rows = spark.range(part * 90, part * 90 + 90).selectExpr(
            "id AS v", "IF(id % 3 = 0, NULL, 'x=y') AS p", "IF(id % 2 = 0, NULL, 7) AS q"
        )
        sinks.append_rows(rows, path, ["p", "q"])
    sinks.append_rows(spark.range(5).selectExpr("id AS v", "'one' AS p", "1L AS q"), path, ["p", "q"])
    before = Counter(tuple(r) for r in spark.read.schema(stored).parquet(path).collect())
    with pytest.raises(ValueError, match="laid out"):
        upkeep.compact(spark, path, stored, "q", ["v"], state, "a")
    with pytest.raises(ValueError, match="laid out"):
        upkeep.compact(spark, path, stored, ["q", "p"], ["v"], state, "a")
    done = upkeep.compact(spark, path, stored, ["p", "q"], ["v"], state, "a")
    assert done == [(None, None), (None, "7"), ("x=y", None), ("x=y", "7")]
    assert Counter(tuple(r) for r in spark.read.schema(stored).parquet(path).collect()) == before
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in Path(path).glob("p=*/q=*"))


def test_catalog_table_is_pointed_at_its_new_files(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS upkeep")
    rows = spark.read.parquet(f"{SMALL}/orders.parquet")
    rows.write.option("path", f"{folder}/old").saveAsTable("upkeep.orders")
    upkeep.recluster_table(spark, "upkeep.orders", ["o_custkey"], f"{folder}/new", 8 * 1024)
    table = spark.read.table("upkeep.orders")
    assert all("/new/" in name for name in table.inputFiles())
    assert table.exceptAll(rows).count() == 0 and table.count() == rows.count()
    rows.write.partitionBy("o_orderpriority").option("path", f"{folder}/cut").saveAsTable("upkeep.cut")
    upkeep.recluster_table(spark, "upkeep.cut", ["o_custkey"], scratch(spark, "cut"))
    found = spark.read.table("upkeep.cut").select(rows.columns)
    assert found.exceptAll(rows).count() == 0 and found.count() == rows.count()


def summaries(spark, first, last, average):
    """One row per turbine and day, as gold holds them."""
    return spark.sql(
        f"""SELECT CAST(turbine AS INT) AS turbine_id, date_add(DATE '2024-01-01', CAST(day AS INT)) AS date,
            CAST({average} AS DOUBLE) AS avg_power_output, 1.0D AS min_power_output, 9.0D AS max_power_output,
            false AS is_anomaly
        FROM range({first}, {last}) AS days(day), range(2) AS turbines(turbine)"""
    )


def test_many_days_of_few_rows_are_written_by_many_tasks(spark, folder):
    layers = Layers(folder)
    table = gold_table(spark, layers)

    def merge(first, last, average):
        days = [date(2024, 1, 1) + timedelta(days=day) for day in range(first, last)]
        table.merge(summaries(spark, first, last, average), days, batch_name(load_moment(1)))

    def writers():
        return {path.name.split("-")[1] for path in Path(layers.gold).glob("date=*/*.parquet")}

    merge(0, 40, 2)
    assert len(writers()) > 1
    merge(30, 80, 3)
    assert len(writers()) > 1
    files = Counter(path.parent.name for path in Path(layers.gold).glob("date=*/*.parquet"))
    assert len(files) == 80 and set(files.values()) == {1}
    assert not list(Path(layers.staging("gold_incoming")).glob("date=*"))
    wanted = summaries(spark, 0, 30, 2).unionByName(summaries(spark, 30, 80, 3))
    assert sorted(table.rows().select(*wanted.columns).collect()) == sorted(wanted.collect())


def test_a_new_folder_moves_in_as_a_whole(spark, folder, monkeypatch):
    path = f"{folder}/t"
    sinks.append_rows(spark.range(4).selectExpr("id AS v", "'old' AS p"), path, ["p"])
    swap, moved, real = FileSwap(spark, path, f"{folder}/state"), [], FileSwap._move
    rows = swap.begin(["p=old"], STORED)
    new = spark.range(10, 16).selectExpr("id AS v", "'new/a b' AS p").repartition(3)
    sinks.stage(rows.unionByName(new), swap.staged, ["p"], spread="as is")
    staged = [file.parent.name for file in Path(swap.staged).glob("p=*/*.parquet")]
    assert staged.count("p=new%2Fa b") > 1

    def noted(self, *args):
        moved.append(args[1:])
        real(self, *args)

    monkeypatch.setattr(FileSwap, "_move", noted)
    assert swap.finish() == []
    assert [place for place in moved if place[0] != "p=old"] == [("", "p=new%2Fa b")]
    found = spark.read.schema(STORED).parquet(path)
    assert sorted(row["v"] for row in found.collect()) == [0, 1, 2, 3, *range(10, 16)]
