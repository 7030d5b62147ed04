from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from strataflux import schemas
from strataflux.functions.numbers import conform, is_whole
from strataflux.operators import quality
from strataflux.operators.conform import cast_to_schema, not_null_violations

MEASURES = StructType([StructField(name, StringType()) for name in ["row", *schemas.MEASURES]])

# row, wind speed, wind direction, power, outcome
EDGE_ROWS = [
    ("gap", None, "10", "1", "null"),
    ("all gaps", None, None, None, "null"),
    ("low bounds", "3", "0", "0.5", "valid"),
    ("high bounds", "25", "360", "9", "valid"),
    ("just above", "25.9", "10", "1", "invalid"),
    ("just below", "2.9", "10", "1", "invalid"),
    ("no power", "5", "10", "0", "invalid"),
    ("negative", "5", "10", "-1", "invalid"),
    ("text", "x", "10", "1", "invalid"),
    ("nan", "5", "10", "NaN", "invalid"),
    ("infinite", "5", "10", "Infinity", "invalid"),
    ("beyond circle", "5", "360.1", "1", "invalid"),
    ("fraction of degree", "5", "359.7", "1", "valid"),
]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    """Outcomes must not depend on ANSI mode."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def edges(spark):
    return spark.createDataFrame([row[:4] for row in EDGE_ROWS], MEASURES)


def names(df):
    return sorted(row["row"] for row in df.select("row").collect())


def expected(outcome):
    return sorted(row[0] for row in EDGE_ROWS if row[4] == outcome)


def test_splits_follow_the_edge_rows(edges, ansi):
    complete, nulls = quality.split_nulls(edges, schemas.MEASURES)
    valid, invalid = quality.split_rules(complete, quality.reading_rules())
    assert names(nulls) == expected("null")
    assert names(valid) == expected("valid")
    assert names(invalid) == expected("invalid")


def test_null_split_can_ask_for_all_columns(edges):
    kept, dropped = quality.split_nulls(edges, schemas.MEASURES, how="all")
    assert names(dropped) == ["all gaps"]
    assert kept.count() + dropped.count() == len(EDGE_ROWS)
    with pytest.raises(ValueError):
        quality.split_nulls(edges, schemas.MEASURES, how="some")


def test_unknown_condition_counts_as_not_met(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "row int, v int")
    valid, invalid = quality.split_rules(df, F.col("v") > 1)
    assert [r.row for r in valid.collect()] == [2]
    assert [r.row for r in invalid.collect()] == [1]


def test_reasons_agree_with_the_splits(edges, ansi):
    good, bad = quality.split_with_reason(
        edges, schemas.MEASURES, quality.reading_rules(), notes=quality.number_notes()
    )
    assert names(good) == expected("valid")
    reasons = {row["row"]: row[quality.REASON] for row in bad.collect()}
    assert sorted(reasons) == sorted(expected("null") + expected("invalid"))
    assert reasons["gap"] == "wind_speed is null"
    assert reasons["all gaps"] == "wind_speed is null; wind_direction is null; power_output is null"
    assert reasons["just above"] == "wind_speed out of range"
    assert reasons["text"] == "wind_speed is not a number; wind_speed out of range"
    assert reasons["nan"] == "power_output is not a number; power_output not above zero"


def test_reject_log_matches_columns_by_name(spark):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    other = spark.createDataFrame([(4, 3), (4, 3)], "b int, a int")
    rows = sorted(tuple(r) for r in quality.reject_log(one, other).collect())
    assert rows == [(1, 2), (3, 4), (3, 4)]


def test_cast_never_throws_and_truncates(spark, ansi):
    texts = ["359.7", "-0.7", "12", " 5 ", "x", "NaN", "Infinity", "99999999999", None]
    df = spark.createDataFrame([(t, t) for t in texts], "n string, other string")
    typed = cast_to_schema(df, StructType([StructField("n", IntegerType()), StructField("gone", IntegerType())]))
    assert typed.columns == ["n", "other"]
    assert [r.n for r in typed.collect()] == [359, 0, 12, 5, None, None, None, None, None]
    assert [r.other for r in typed.collect()] == texts


def test_cast_of_timestamps(spark, ansi):
    df = spark.createDataFrame([("2022-03-01 02:00:00",), ("not a time",)], "timestamp string")
    typed = cast_to_schema(df, schemas.SILVER)
    shown = typed.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert [r.t for r in shown] == ["2022-03-01 02:00:00", None]


def test_cast_is_one_projection(spark):
    df = spark.createDataFrame([("1",) * 5], schemas.ARRIVAL)
    plan = cast_to_schema(df, schemas.SILVER)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_not_null_counts(spark):
    load = datetime(2024, 1, 1)
    rows = [(load, None, "1", None, None, None), (load, "t", None, None, None, None), (load, None, "1", "2", "3", "4")]
    nullable = StructType([StructField(f.name, f.dataType) for f in schemas.BRONZE])
    counts = not_null_violations(spark.createDataFrame(rows, nullable), schemas.BRONZE)
    assert {r.column_name: r.violations for r in counts.collect()} == {
        "load_datetime": 0,
        "timestamp": 2,
        "turbine_id": 1,
    }


def test_long_numbers_keep_their_digits(spark):
    texts = ["9007199254740993", "-9007199254740993.9", "12e2", "0x10", "1d", "NaN", "x", " 7 ", "99999999999999999999"]
    df = spark.createDataFrame([(text,) for text in texts], "v string")
    got = [row[0] for row in df.select(conform(F.col("v"), StringType(), LongType())).collect()]
    assert got == [9007199254740993, -9007199254740993, 1200, None, None, None, None, 7, None]
    whole = [row[0] for row in df.select(is_whole(F.col("v"))).collect()]
    assert whole == [True, False, True, False, False, False, False, True, True]


def test_schema_without_demands_has_no_violations(spark):
    schema = StructType([StructField("v", LongType(), True)])
    assert not_null_violations(spark.range(1).withColumnRenamed("id", "v"), schema).collect() == []


WHOLE_TEXTS = ["7", "07", " 7 ", "-7.0", "+7.", ".0", "7e0", "70e-1", "7.10e1", "0e-9", "0.000", "12345678901234567890e5"]
OTHER_TEXTS = ["7.0000000000000000001", "1e-30", "7e-1", "7.01e1", "0.5", "", ".", "e5", "7d", "0x7", "NaN", "1e", "x", None]


def test_whole_numbers_by_their_digits(spark):
    rows = spark.createDataFrame([(text,) for text in [*WHOLE_TEXTS, *OTHER_TEXTS]], "t string")
    found = rows.where(is_whole(F.col("t"))).collect()
    assert [row["t"] for row in found] == WHOLE_TEXTS


def test_only_plain_decimals_are_numbers(spark):
    texts = ["10d", "10f", "0x1p3", "NaN", "Infinity", "-inf", "1e999x", " 2.5 ", "1e2", ".5", "5."]
    rows = spark.createDataFrame([(text,) for text in texts], "t string")
    numbers = rows.select(conform(F.col("t"), StringType(), DoubleType()).alias("n")).collect()
    assert [row["n"] for row in numbers] == [None] * 7 + [2.5, 100.0, 0.5, 5.0]
