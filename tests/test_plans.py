"""What the plans must look like for the work to hold at scale."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from strataflux import schemas
from strataflux.operators import incremental, joins, merge, quality
from strataflux.operators.summary import daily_summary
from strataflux.plans.days import on_days
from strataflux.plans.silver import pending, typed_rows
from strataflux.sources import sinks
from strataflux.sources.tables import Layers, read_dataset
from workloads import data, operators

HOT = 7


@contextmanager
def settings(spark, **values):
    values = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def no_broadcast(spark, **more):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        **more,
    )


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan after running, with what was decided at run time."""
    df.collect()
    return planned(df).split("Initial Plan")[0]


def hot_frame(spark, column="k", partitions=12):
    """Two rows in five share one key."""
    return spark.range(0, 40_000, 1, partitions).selectExpr(
        f"IF(id % 5 < 2, {HOT}, id) AS {column}", "id AS v", "repeat('x', 20) AS pad"
    )


@pytest.mark.parametrize("how", ["left_anti", "left_semi"])
def test_hot_source_key_is_split(spark, how):
    source, target = hot_frame(spark), hot_frame(spark, "t").where("v % 3 = 0")
    with no_broadcast(spark):
        plan = executed(joins.key_join(source, target, [("k", "t")], how))
    assert "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_hot_key_is_split_in_joins_that_return_both_sides(spark, how):
    source = hot_frame(spark).where(f"k <> {HOT} OR v < 10")
    with no_broadcast(spark):
        joined = joins.key_join(source, hot_frame(spark, "t"), [("k", "t")], how)
        assert "SortMergeJoin(skew=true)" in executed(joined)


def test_target_keys_are_reduced_before_the_shuffle(spark):
    """A key in 16,000 target rows reaches the join at most once per slot."""
    keys = joins.distinct_keys(hot_frame(spark), ["k"])
    assert keys.where(F.col("k") == HOT).count() <= joins.KEY_SLOTS
    assert keys.distinct().count() == hot_frame(spark).select("k").distinct().count()
    assert planned(keys).count("HashAggregate") == 2


def test_small_side_is_broadcast_without_a_hint(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    assert "BroadcastHashJoin" in executed(merge.absent_rows(orders, orders.where("o_orderkey < 5"), ["o_orderkey"]))


def test_anti_join_reads_keys_of_the_target_only(spark):
    plan = planned(operators.unseen_orders(spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan


@pytest.mark.parametrize(
    "build",
    [
        lambda df: daily_summary(df.withColumn("date", F.lit("d")), ["k", "date"], "v"),
        lambda df: merge.latest_per_key(df, ["k"], ["v"]),
    ],
    ids=["summary", "latest"],
)
def test_groups_are_reduced_before_the_shuffle(spark, build):
    plan = planned(build(hot_frame(spark)))
    assert "partial_max" in plan and plan.count("Exchange") == 1 and "Window" not in plan


def test_upsert_shuffles_stored_rows_once_or_not_at_all(spark):
    stored, incoming = hot_frame(spark).where(f"k <> {HOT}"), hot_frame(spark)
    with no_broadcast(spark):
        plan = executed(merge.upsert(incoming, stored, ["k"], ["v"]))
    # The incoming rows for the reduction, their keys and the stored rows for the join.
    assert plan.count("Exchange hashpartitioning") == 3
    few = executed(merge.upsert(incoming.where("v < 50"), stored, ["k"], ["v"]))
    assert "BroadcastHashJoin" in few and "SortMergeJoin" not in few


def test_splits_are_narrow_and_push_their_filters(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    complete, nulls = quality.split_nulls(events, ["value", "props"])
    for part in (complete, nulls):
        assert "Exchange" not in planned(part)
    assert "PushedFilters: [Or(IsNull(value),IsNull(props))]" in planned(nulls)


def test_nothing_runs_in_python(spark):
    for build in (operators.daily_summary_valid, operators.reject_reasons, operators.latest_per_key):
        plan = planned(build(spark, SMALL))
        assert "Python" not in plan and "Pandas" not in plan


def test_checks_stay_in_generated_code(spark):
    plan = operators.reject_reasons(spark, SMALL)
    text = executed(plan)
    assert "*(1) Project" in text or "*(1) Filter" in text


def test_mark_is_a_subquery_of_its_own(spark):
    source = data.table(spark, SMALL, "lineitem")
    orders = data.table(spark, SMALL, "orders").withColumnRenamed("o_orderdate", "l_shipdate")
    plan = planned(incremental.newer_than(source, orders, "l_shipdate"))
    assert "Subquery" in plan and "Join" not in plan


def test_partitions_are_pruned_at_planning_time(spark, folder):
    rows = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-05')) AS date, 1L AS v")
    sinks.replace_partitions(rows, folder, ["date"])
    table = read_dataset(spark, folder, rows.schema)
    days = [row[0] for row in rows.select("date").collect()][1:3]
    picked = table.where(on_days(days))
    assert "PartitionFilters: [date" in planned(picked)
    assert len(picked.inputFiles()) <= len(table.inputFiles())
    assert picked.count() == 2


def test_pending_batches_prune_bronze(spark, folder):
    layers = Layers(folder)
    stored = schemas.stored(schemas.BRONZE, schemas.BRONZE_PARTITIONS)
    rows = spark.createDataFrame([], stored)
    rows = rows.unionByName(
        spark.sql(
            """SELECT now() AS load_datetime, 't' AS timestamp, '1' AS turbine_id, '1' AS wind_speed,
            '1' AS wind_direction, '1' AS power_output, DATE '2024-01-01' AS day,
            explode(array('a', 'b', 'c')) AS batch_id"""
        )
    )
    sinks.replace_partitions(rows, layers.bronze, ["day", "batch_id"])
    window = pending(spark, layers, "a", "b")
    assert "PartitionFilters: [isnotnull(batch_id" in planned(window)
    assert [r.batch_id for r in window.collect()] == ["b"]
    # Finding the days a merge touches reads one column of the batch.
    assert "ReadSchema: struct<timestamp:string>" in planned(typed_rows(window).select("date").distinct())
