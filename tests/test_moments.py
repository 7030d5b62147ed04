"""Moments of parts put together equal those of all rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from strataflux.operators.moments import combined_moments, deviation, moments
from strataflux.operators.summary import daily_summary, summary_of_moments


def test_parts_put_together_equal_the_whole(spark):
    chance = random.Random(5)
    rows = [(f"g{k % 5}", k % 4, 1e9 + chance.random()) for k in range(400)]
    rows += [("one", 0, 3.5), ("none", 0, None), ("none", 1, None), ("half", 0, None), ("half", 1, 2.0), ("half", 2, 4.0)]
    rows += [(None, 0, 1.0), (None, 1, 2.0)]
    df = spark.createDataFrame(rows, "name string, part int, value double")
    parts = moments(df, ["name", "part"], "value").drop("part")
    got = {r.name: r for r in combined_moments(parts, ["name"]).withColumn("deviation", deviation()).collect()}
    assert set(got) == {name for name, _, _ in rows}
    for name, found in got.items():
        known = [value for group, _, value in rows if group == name and value is not None]
        assert found.readings == len(known)
        if not known:
            assert (found.mean, found.squares, found.low, found.high, found.deviation) == (None,) * 5
            continue
        assert (found.low, found.high) == (min(known), max(known))
        assert found.mean == pytest.approx(statistics.fmean(known), rel=1e-14)
        if len(known) > 1:
            assert found.deviation == pytest.approx(statistics.stdev(known), rel=1e-6)
        else:
            assert found.deviation is None


def test_no_rows(spark):
    df = spark.createDataFrame([], "name string, value double")
    assert combined_moments(moments(df, ["name"], "value"), ["name"]).collect() == []


def test_summary_from_moments_equals_the_summary(spark):
    chance = random.Random(6)
    rows = [(k % 7, k % 3, round(chance.gauss(5, 1), 2)) for k in range(300)] + [(0, 0, 50.0), (9, 0, 1.25)]
    df = spark.createDataFrame(rows, "turbine_id int, batch int, power double")
    keys = ["turbine_id"]
    wanted = daily_summary(df, keys, "power")
    known = combined_moments(moments(df, [*keys, "batch"], "power").drop("batch"), keys)
    got = summary_of_moments(known, keys, "power")
    assert got.columns == wanted.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    assert got.where(F.col("is_anomaly")).count() >= 1
