"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import differences, engine
from conftest import SMALL

import __spark_entry__ as registered
from workloads import oracles


@pytest.fixture(scope="module")
def connection():
    return engine(SMALL)


def test_contract(spark):
    assert oracles.sql().keys() <= registered.queries().keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()
    assert registered.entry(spark).columns == [
        "turbine_id",
        "date",
        "avg_power_output",
        "min_power_output",
        "max_power_output",
        "is_anomaly",
    ]


@pytest.mark.parametrize("name", oracles.sql())
def test_query_matches_its_sql(spark, connection, name):
    _, found = differences(
        spark, connection, SMALL, registered.queries()[name], oracles.sql()[name]
    )
    assert not found, found


def test_compacted_bronze_keeps_its_rows_off_the_driver(spark, monkeypatch):
    frame, fetched = type(spark.range(1)), []
    collect = frame.collect

    def noted(rows):
        fetched.append(rows.columns)
        return collect(rows)

    monkeypatch.setattr(frame, "collect", noted)
    registered.queries()["compacted_bronze"](spark, SMALL)
    assert fetched and not [columns for columns in fetched if "power_output" in columns]
