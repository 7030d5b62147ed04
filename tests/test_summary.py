from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from strataflux.functions.numbers import rounded
from strataflux.functions.times import add_day, batch_moment, batch_name
from strataflux.operators.summary import daily_summary


def flag(spark, values, deviations=2.0):
    df = spark.createDataFrame([(1, date(2024, 1, 1), float(v)) for v in values], "turbine_id int, date date, power_output double")
    return daily_summary(df, deviations=deviations).first()


@pytest.mark.parametrize(
    ("values", "anomaly"),
    [([5], False), ([1, 1, 1, 1, 100], False), ([1, 1, 1, 1, 1, 100], True), ([100, 100, 100, 100, 100, 1], True)],
)
def test_anomaly_needs_two_deviations(spark, values, anomaly):
    assert flag(spark, values).is_anomaly is anomaly


def test_deviations_are_a_parameter(spark):
    assert flag(spark, [1, 1, 1, 1, 100], deviations=1.5).is_anomaly is True


def test_statistics(spark):
    row = flag(spark, [1.005, 2.0, 3.333])
    assert (row.avg_power_output, row.min_power_output, row.max_power_output) == (2.11, 1.005, 3.333)


def test_rounding_of_ties_and_extremes(spark):
    values = [88.165, 0.125, -0.125, 1e300, float("nan"), float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(rounded(F.col("v"), 2)).collect()]
    assert got[:4] == [88.17, 0.13, -0.13, 1e300]
    assert got[4] != got[4] and got[5] == float("inf") and got[6] is None


@pytest.mark.parametrize("session", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_day_does_not_depend_on_the_session(spark, session):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session)
    try:
        df = spark.sql(
            """SELECT explode(array(TIMESTAMP '2022-03-01T00:30:00Z', TIMESTAMP '2022-03-01T23:59:59.999999Z',
            TIMESTAMP '1969-12-31T23:59:59.999999Z', TIMESTAMP '1970-01-01T00:00:00Z')) AS t"""
        )
        utc = [r.date for r in add_day(df, "t").collect()]
        assert utc == [date(2022, 3, 1), date(2022, 3, 1), date(1969, 12, 31), date(1970, 1, 1)]
        local = [r.date for r in add_day(df, "t", zone="America/New_York").collect()]
        assert local == [date(2022, 2, 28), date(2022, 3, 1), date(1969, 12, 31), date(1969, 12, 31)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_batch_names_keep_time_order():
    early = datetime(2024, 1, 2, 3, 4, 5, 6, tzinfo=timezone.utc)
    assert batch_name(early) == "20240102_030405_000006"
    assert batch_moment(batch_name(early)) == early
    assert batch_name(early) < batch_name(early.replace(microsecond=7))
