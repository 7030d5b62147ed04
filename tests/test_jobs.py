"""The three stages over small hand-made deliveries, with failures thrown in."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta, timezone
from functools import cache
from pathlib import Path
from shutil import copytree
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from strataflux import schemas
from strataflux.plans import bronze as bronze_plan
from strataflux.plans import batchlog, days, gold as gold_plan, moment_log, silver as silver_plan, swap, verdicts
from strataflux.functions.times import batch_name
from strataflux.plans.batchlog import BatchLog
from strataflux.plans.bronze import load_arrivals, read_bronze
from strataflux.plans.gold import gold, read_gold
from strataflux.plans.silver import read_error_log, read_silver, silver
from strataflux.plans.swap import gold_table
from strataflux.plans.file_swap import FileSwap
from strataflux.plans.upkeep import compact_layers
from strataflux.session import scratch
from strataflux.sources import sinks
from strataflux.sources.registry import read_registry
from strataflux.sources.sinks import replace_partitions
from strataflux.sources.tables import GOLD_NAME, SILVER_NAME, Layers, create_layers

START = datetime(2024, 6, 1, 12, tzinfo=timezone.utc)


class Crash(Exception):
    pass


def at(number):
    return START + timedelta(hours=number)


def reading(day, hour, turbine="1", speed="10", turn="90", power="5.0"):
    return (f"2024-05-{day:02d} {hour:02d}:00:00", turbine, speed, turn, power)


def deliver(spark, layers, number, rows, mode="insert_only"):
    return load_arrivals(spark, layers, spark.createDataFrame(rows, schemas.ARRIVAL), at(number), mode)


def content(df):
    return Counter(tuple(r) for r in df.collect())


def tables(spark, layers):
    return {
        "bronze": content(read_bronze(spark, layers).select(*schemas.BRONZE.names)),
        "errors": content(read_error_log(spark, layers)),
        "silver": content(read_silver(spark, layers)),
        "gold": content(read_gold(spark, layers)),
    }


def powers(spark, layers):
    rows = read_silver(spark, layers).select("turbine_id", F.dayofmonth("timestamp"), "power_output").collect()
    return sorted(tuple(r) for r in rows)


DELIVERIES = [
    [reading(1, h, t, power=str(h + 1.0)) for h in range(3) for t in ("1", "2")] + [reading(1, 5, power=None)],
    [reading(1, 9), reading(2, 1), reading(2, 2, speed="99"), reading(2, 3, turbine="x")],
    [reading(2, 4, "2"), reading(3, 1), reading(1, 0, power="77"), reading(3, 2, turn="bad")],
]


def run(spark, layers, deliveries=DELIVERIES, gold_mode="touched"):
    for number, rows in enumerate(deliveries):
        deliver(spark, layers, number, rows)
        silver(spark, layers)
        gold(spark, layers, gold_mode)


def test_three_runs_equal_one(spark, folder):
    apart, together = Layers(f"{folder}/apart"), Layers(f"{folder}/together")
    run(spark, apart)
    first_wins = {}
    for row in [row for rows in DELIVERIES for row in rows]:
        first_wins.setdefault(row[:2], row)
    run(spark, together, [list(first_wins.values())])
    got, wanted = tables(spark, apart), tables(spark, together)
    for name, first in (("silver", 1), ("errors", 1), ("gold", 0)):
        assert Counter(r[first:] for r in got[name].elements()) == Counter(
            r[first:] for r in wanted[name].elements()
        )


def test_rejects_carry_reasons(spark, folder):
    layers = Layers(folder)
    run(spark, layers)
    reasons = Counter(r.reject_reason for r in read_error_log(spark, layers).collect())
    assert reasons == {
        "power_output is null": 1,
        "wind_speed out of range": 1,
        "turbine_id is not a valid int": 1,
        "wind_direction is not a number; wind_direction out of range": 1,
    }


def test_keys_must_be_whole_and_numbers_plain(spark, folder):
    layers = Layers(folder)
    rows = [reading(1, 0, "1"), reading(1, 0, "1.9"), reading(1, 1, "2.0"), reading(1, 2, speed="10d")]
    rows += [reading(1, 3, speed="0x1p3"), reading(1, 4, speed="1e1"), reading(1, 5, turn="NaN")]
    deliver(spark, layers, 0, rows)
    silver(spark, layers)
    assert sorted(r.turbine_id for r in read_silver(spark, layers).collect()) == [1, 1, 2]
    reasons = Counter(r.reject_reason for r in read_error_log(spark, layers).collect())
    assert reasons == {
        "turbine_id is not a valid int": 1,
        "wind_speed is not a number; wind_speed out of range": 2,
        "wind_direction is not a number; wind_direction out of range": 1,
    }


def test_load_repeated_with_corrected_rows_keeps_the_new_ones(spark, folder, monkeypatch):
    layers = Layers(folder)
    with monkeypatch.context() as patch:
        crash_after(patch, bronze_plan, "replace_partitions")
        with pytest.raises(Crash):
            deliver(spark, layers, 0, [reading(1, 0), reading(2, 0)])
    deliver(spark, layers, 0, [reading(3, 0), reading(2, 0)])
    assert sorted(r.timestamp[8:10] for r in read_bronze(spark, layers).collect()) == ["02", "03"]


def test_upkeep_of_all_layers(spark, folder):
    layers = Layers(folder)
    run(spark, layers)
    before = tables(spark, layers)
    # Many files in the partitions there are.
    for path, columns in ((layers.silver, ["date"]), (layers.bronze, ["day", "batch_id"])):
        rows = spark.read.option("basePath", path).parquet(path)
        for part in range(3):
            picked = rows.where(F.pmod(F.xxhash64("timestamp", "turbine_id"), F.lit(3)) == part)
            sinks.append_rows(picked, f"{folder}/copy/{columns[0]}", columns)
        copytree(f"{folder}/copy/{columns[0]}", path, dirs_exist_ok=True)
    compact_layers(spark, layers, at(50))
    doubled = tables(spark, layers)
    assert {key: 2 * n for key, n in before["silver"].items()} == doubled["silver"]
    assert doubled["errors"] == before["errors"] and doubled["gold"] == before["gold"]
    assert {key: 2 * n for key, n in before["bronze"].items()} == doubled["bronze"]
    with pytest.raises(ValueError, match="come after"):
        compact_layers(spark, layers, at(50))


def test_redelivered_key_is_ignored_or_corrects(spark, folder):
    for mode, wanted in (("insert_only", 5.0), ("append", 8.0)):
        layers = Layers(f"{folder}/{mode}")
        deliver(spark, layers, 0, [reading(1, 0)], mode)
        silver(spark, layers)
        deliver(spark, layers, 1, [reading(1, 0, power="8.0")], mode)
        silver(spark, layers)
        assert powers(spark, layers) == [(1, 1, wanted)]


def test_two_spellings_of_a_key_meet_in_silver(spark, folder):
    layers = Layers(folder)
    deliver(spark, layers, 0, [reading(1, 0, "1", power="5"), reading(1, 0, "01", power="6")])
    silver(spark, layers)
    assert read_bronze(spark, layers).count() == 2
    assert powers(spark, layers) == [(1, 1, 6.0)]


def test_repeats_in_one_delivery(spark, folder):
    layers = Layers(folder)
    deliver(spark, layers, 0, [reading(1, 0, power="5"), reading(1, 0, power="6"), reading(1, 0, power="6")])
    silver(spark, layers)
    assert read_bronze(spark, layers).count() == 3
    assert powers(spark, layers) == [(1, 1, 6.0)]


def test_readings_without_a_day_are_kept_and_matched(spark, folder):
    layers = Layers(folder)
    odd = [("garbage", "1", "10", "90", "5"), (None, "1", "10", "90", "5")]
    deliver(spark, layers, 0, odd)
    deliver(spark, layers, 1, odd)
    times = Counter(r.timestamp for r in read_bronze(spark, layers).collect())
    assert times == {"garbage": 1, None: 2}
    silver(spark, layers)
    assert read_error_log(spark, layers).count() == 3
    assert read_silver(spark, layers).count() == 0


def test_batch_of_rejects_is_read_once(spark, folder):
    layers = Layers(folder)
    deliver(spark, layers, 0, [reading(1, 0, power="0")])
    assert silver(spark, layers) is not None
    assert silver(spark, layers) is None
    assert read_error_log(spark, layers).count() == 1


def test_silver_reads_pending_rows_once(spark, folder, monkeypatch):
    """Once rows are staged by verdict the run goes on without bronze, on a first load and on a merge."""
    layers, real = Layers(folder), verdicts.stage
    elsewhere = f"{folder}/aside"
    monkeypatch.setattr(
        verdicts, "stage", lambda *args, **named: (real(*args, **named), Path(layers.bronze).rename(elsewhere))
    )
    for number, rows in enumerate(DELIVERIES):
        deliver(spark, layers, number, rows)
        silver(spark, layers)
        Path(elsewhere).rename(layers.bronze)
    runs = [tuple(row) for row in verdicts.read_runs(spark, layers).orderBy("batch_id").collect()]
    assert [row[0] for row in runs] == [batch_name(at(number)) for number in range(3)]
    assert [row[1:] for row in runs] == [(7, 1, 1, 1), (4, 0, 2, 2), (3, 0, 1, 2)]
    assert read_silver(spark, layers).count() == 10
    assert read_error_log(spark, layers).count() == 4


def test_catalog_sees_each_batch(spark, folder, monkeypatch):
    """By name, also where a run breaks off after its days were written."""
    layers, prefix = Layers(folder), f"t{uuid4().hex}_"
    assert create_layers(spark, layers, prefix) == {}
    named = {"silver": prefix + SILVER_NAME, "gold": prefix + GOLD_NAME}

    def by_name(layer, schema):
        return content(spark.read.table(named[layer]).select(*schema.names))

    for number, rows in enumerate(DELIVERIES):
        deliver(spark, layers, number, rows)
        if number == 2:
            with monkeypatch.context() as patch:
                crash_after(patch, FileSwap, "finish")
                with pytest.raises(Crash):
                    silver(spark, layers, name=named["silver"])
        silver(spark, layers, name=named["silver"])
        gold(spark, layers, "touched", name=named["gold"])
        assert by_name("silver", schemas.SILVER) == content(read_silver(spark, layers))
        assert by_name("gold", schemas.GOLD) == content(read_gold(spark, layers))
    assert by_name("gold", schemas.GOLD)


def test_long_log_is_folded_and_keeps_every_entry(spark, folder, monkeypatch):
    log = BatchLog(spark, f"{folder}/log")
    assert log.fold(0) is False
    for number in range(6):
        log.record("bronze", f"b{number}")
    log.record("silver", "b2")

    def told():
        return log.marks(), log.unfinished("bronze", "silver"), log.holds("bronze", "b0"), log.holds("silver", "b0")

    before = told()
    assert log.fold(7) is False and log.fold(6) is True
    assert told() == before
    assert len(list(Path(log.path).glob("*.parquet"))) == 1
    log.record("silver", "b5")
    with monkeypatch.context() as patch:
        # Breaks off with the folded file in place beside all old ones.
        crash_after(patch, batchlog, "moved_in")
        with pytest.raises(Crash):
            log.fold(1)
    assert len(list(Path(log.path).glob("*.parquet"))) == 3
    assert log.mark("silver") == "b5" and log.marks()["bronze"] == "b5"
    assert log.unfinished("bronze", "silver") == ["b0", "b1", "b3", "b4"]
    assert log.fold(1) and len(list(Path(log.path).glob("*.parquet"))) == 1
    assert log.unfinished("bronze", "silver") == ["b0", "b1", "b3", "b4"]


def test_late_reading(spark, folder):
    late = [[reading(1, 0, power="4")], [reading(1, 1, power="8"), reading(1, 1, "2", power="3")]]
    for mode, average in (("unseen", 4.0), ("touched", 6.0)):
        layers = Layers(f"{folder}/{mode}")
        run(spark, layers, late, mode)
        averages = {r.turbine_id: r.avg_power_output for r in read_gold(spark, layers).collect()}
        assert averages == {1: average, 2: 3.0}


def test_touched_makes_up_for_what_unseen_passed_over(spark, folder):
    layers = Layers(folder)
    run(spark, layers, [[reading(1, 0, power="4")], [reading(1, 1, power="8")]], "unseen")
    assert [r.avg_power_output for r in read_gold(spark, layers).collect()] == [4.0]
    gold(spark, layers, "touched")
    assert [r.avg_power_output for r in read_gold(spark, layers).collect()] == [6.0]


def expected_gold(spark, layers):
    return content(gold_plan.summarise(swap.silver_table(spark, layers).rows()).select(*schemas.GOLD.names))


def no_reading_of_silver(*args):
    raise AssertionError("silver was read")


def test_touched_gold_takes_moments_and_reads_no_silver(spark, folder, monkeypatch):
    """Late readings, replaced ones, and both in days that are new, held and untouched."""
    layers = Layers(folder)
    steps = [
        [reading(d, h, t, power=str(d + h / 7)) for d in (1, 2, 3) for h in range(4) for t in ("1", "2")],
        [reading(1, 7, power="90"), reading(2, 1, power="0.5"), reading(4, 0, power="8"), reading(2, 9, "2", power="3")],
        [reading(2, 8, power="6.25"), reading(1, 7, power="1"), reading(4, 1, power="8"), reading(3, 0, "3")],
    ]
    for number, rows in enumerate(steps):
        deliver(spark, layers, number, rows, "append")
        silver(spark, layers)
        with monkeypatch.context() as patch:
            patch.setattr(gold_plan, "silver_table", no_reading_of_silver)
            gold(spark, layers, "touched")
        assert content(read_gold(spark, layers)) == expected_gold(spark, layers)


def test_touched_gold_over_several_batches_and_days_without_notes(spark, folder, monkeypatch):
    layers = Layers(folder)
    with monkeypatch.context() as patch:
        # As silver worked before it took notes.
        patch.setattr(moment_log.MomentLog, "_write", lambda *args: None)
        deliver(spark, layers, 0, [reading(d, h, power=str(h + 1.5)) for d in (1, 2, 3) for h in range(3)])
        silver(spark, layers)
    gold(spark, layers, "touched")
    assert content(read_gold(spark, layers)) == expected_gold(spark, layers)
    for number in (1, 2):
        deliver(spark, layers, number, [reading(2, 10 + number, power="9"), reading(5, number, "2", power="4")])
        silver(spark, layers)
    gold(spark, layers, "touched")
    assert content(read_gold(spark, layers)) == expected_gold(spark, layers)


def test_notes_of_a_broken_off_run_do_not_count(spark, folder, monkeypatch):
    """Repeated with rules that now reject a day the first attempt had noted."""
    layers = Layers(folder)
    run(spark, layers, [[reading(1, 0), reading(2, 0)]])
    deliver(spark, layers, 1, [reading(1, 1, power="50"), reading(2, 1, power="7")])
    with monkeypatch.context() as patch:
        crash_after(patch, moment_log, "replace_partitions")
        with pytest.raises(Crash):
            silver(spark, layers)
    silver(spark, layers, rules={"too much": F.col("power_output").cast("double") < 20})
    gold(spark, layers, "touched")
    assert content(read_gold(spark, layers)) == expected_gold(spark, layers)
    assert sorted(r.avg_power_output for r in read_gold(spark, layers).collect()) == [5.0, 6.0]


def test_removed_gold_days_come_back_on_a_search_of_the_whole_table(spark, folder):
    layers = Layers(folder)
    run(spark, layers, [[reading(1, 0)], [reading(2, 0)]], "unseen")
    held = content(read_gold(spark, layers))
    replace_partitions(
        gold_table(spark, layers).rows().where("dayofmonth(date) = 1").withColumn("turbine_id", F.lit(9)),
        layers.gold,
        ["date"],
    )
    gold(spark, layers)
    assert sorted(r.turbine_id for r in read_gold(spark, layers).collect()) == [1, 9]
    gold(spark, layers, whole_table=True)
    assert content(read_gold(spark, layers).where("turbine_id = 1")) == held


def test_gold_reads_touched_days_only(spark, folder):
    layers = Layers(folder)
    run(spark, layers, [[reading(d, 0) for d in range(1, 6)], [reading(3, 1), reading(9, 0, power="0")]])
    noted = days.DayLog(spark, layers.touched_days)
    first, second = batch_name(at(0)), batch_name(at(1))
    assert sorted(d.day for d in noted.days("", first)) == [1, 2, 3, 4, 5]
    assert sorted(d.day for d in noted.days(first, second)) == [3, 9]


def test_empty_delivery_and_repeated_runs_change_nothing(spark, folder):
    layers = Layers(folder)
    run(spark, layers)
    before = tables(spark, layers)
    assert deliver(spark, layers, 2, DELIVERIES[2]) is False
    deliver(spark, layers, 5, [])
    silver(spark, layers)
    for mode in ("unseen", "touched"):
        gold(spark, layers, mode)
    assert tables(spark, layers) == before


def test_batch_behind_silver_is_refused(spark, folder):
    layers = Layers(folder)
    deliver(spark, layers, 3, [reading(1, 0)])
    silver(spark, layers)
    with pytest.raises(ValueError, match="later load time"):
        deliver(spark, layers, 1, [reading(1, 1)])


def test_unknown_modes_are_refused(spark, folder):
    with pytest.raises(ValueError):
        deliver(spark, Layers(folder), 0, [reading(1, 0)], mode="replace")
    with pytest.raises(ValueError):
        gold(spark, Layers(folder), "everything")


def test_session_zone_does_not_matter(spark, folder):
    layers, before = Layers(folder), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        run(spark, layers, [[reading(1, 0), reading(1, 23)]])
        assert [r.date for r in read_gold(spark, layers).collect()] == [date(2024, 5, 1)]
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_zone_of_silver_is_kept(spark, folder):
    layers = Layers(folder)
    deliver(spark, layers, 0, [("2024-05-01 02:00:00+00:00", "1", "5", "90", "1")])
    silver(spark, layers, zone="America/New_York")
    deliver(spark, layers, 1, [("2024-05-01 02:00:00+00:00", "1", "5", "90", "2")], "append")
    with pytest.raises(ValueError, match="New_York"):
        silver(spark, layers)
    silver(spark, layers, zone="America/New_York")
    assert [p for _, _, p in powers(spark, layers)] == [2.0]


def test_hot_key_and_hot_day_keep_every_row(spark, folder):
    """A third of the arrivals is one key, a third one turbine-day; results match brute force."""
    odd_one_out = [reading(3, 0, power=str(1 + n)) for n in range(2_000)]
    one_day = [(f"2024-05-04 00:00:{n / 100:06.3f}", "2", "10", "90", str(n % 7 + 1)) for n in range(2_000)]
    others = [reading(1 + n % 20, n % 24, str(3 + n // 480), power=str(n % 5 + 1)) for n in range(2_000)]
    rows = odd_one_out + one_day + others
    layers = Layers(folder)
    deliver(spark, layers, 0, rows[::2])
    silver(spark, layers)
    gold(spark, layers)
    deliver(spark, layers, 1, rows, mode="append")
    silver(spark, layers)
    gold(spark, layers, "touched")
    assert read_bronze(spark, layers).count() == 9_000
    best = {}
    for time, turbine, _, _, power in rows:
        key = (int(turbine), datetime.fromisoformat(time))
        best[key] = max(best.get(key, 0.0), float(power))
    groups = {}
    for (turbine, time), power in best.items():
        groups.setdefault((turbine, time.date()), []).append(power)
    got = {(r.turbine_id, r.date): tuple(r)[2:5] for r in read_gold(spark, layers).collect()}
    assert got == {
        key: (pytest.approx(sum(v) / len(v), abs=0.00501), min(v), max(v)) for key, v in groups.items()
    }


def crash_after(monkeypatch, module, name, nth=1):
    """Let the nth call do its work and then fail, once; the 0th fails without having done any."""
    real, calls = getattr(module, name), []

    def failing(*args, **kwargs):
        if nth == 0 and not calls:
            calls.append(1)
            raise Crash
        result = real(*args, **kwargs)
        calls.append(1)
        if len(calls) == nth:
            raise Crash
        return result

    monkeypatch.setattr(module, name, failing)


def crash_halfway(monkeypatch, module, name, keep):
    """Let the call write only part of its rows into the partitions it replaces, once."""
    real, calls = getattr(module, name), []

    def failing(df, *args, **kwargs):
        calls.append(1)
        if len(calls) > 1:
            return real(df, *args, **kwargs)
        real(df.where(keep), *args, **kwargs)
        raise Crash

    monkeypatch.setattr(module, name, failing)


CRASHES = {
    "bronze written": lambda m: crash_after(m, bronze_plan, "replace_partitions"),
    "bronze half written": lambda m: crash_halfway(m, bronze_plan, "replace_partitions", "turbine_id = '1'"),
    "verdicts staged": lambda m: crash_after(m, verdicts, "stage"),
    "run noted": lambda m: crash_after(m, verdicts, "replace_partitions"),
    "rejects written": lambda m: crash_after(m, silver_plan, "replace_partitions"),
    "silver incoming staged": lambda m: crash_after(m, swap, "stage"),
    "silver staged": lambda m: crash_after(m, swap, "stage", 2),
    "moments noted": lambda m: crash_after(m, moment_log, "replace_partitions"),
    "silver not moved in": lambda m: crash_after(m, FileSwap, "finish", 0),
    "silver half moved in": lambda m: crash_after(m, FileSwap, "_move"),
    "silver written": lambda m: crash_after(m, FileSwap, "finish"),
    "gold written": lambda m: crash_after(m, FileSwap, "finish", 2),
    "gold appended": lambda m: crash_after(m, gold_plan, "append_rows"),
    "staging logged": lambda m: crash_after(m, BatchLog, "record", 2),
    "silver logged": lambda m: crash_after(m, BatchLog, "record", 3),
}


@pytest.fixture(scope="module")
def two_runs(spark):
    """Layers after two of the three deliveries, per gold mode; tests work on copies."""

    @cache
    def prepared(mode):
        layers = Layers(scratch(spark, "two-runs"))
        run(spark, layers, DELIVERIES[:2], mode)
        return layers

    return prepared


@pytest.mark.parametrize("crash", CRASHES)
def test_retry_gives_the_result_without_the_crash(spark, folder, monkeypatch, two_runs, crash):
    """The last of three deliveries breaks off somewhere; the whole run is made again."""
    mode = "unseen" if crash == "gold appended" else "touched"

    def last(layers):
        deliver(spark, layers, 2, DELIVERIES[2])
        silver(spark, layers)
        gold(spark, layers, mode)

    calm, rough = Layers(f"{folder}/calm"), Layers(f"{folder}/rough")
    for layers in (calm, rough):
        copytree(two_runs(mode).root, layers.root)
    last(calm)
    with monkeypatch.context() as patch:
        CRASHES[crash](patch)
        with pytest.raises(Crash):
            last(rough)
        last(rough)
    assert tables(spark, rough) == tables(spark, calm)


@pytest.mark.parametrize("crash", ["silver not moved in", "silver half moved in"])
def test_upkeep_between_a_crash_and_its_retry(spark, folder, monkeypatch, two_runs, crash):
    """Days that a broken-off merge has staged are rewritten by another job before the merge goes on."""

    def last(layers):
        deliver(spark, layers, 2, DELIVERIES[2])
        silver(spark, layers)
        gold(spark, layers, "touched")

    calm, rough = Layers(f"{folder}/calm"), Layers(f"{folder}/rough")
    for layers in (calm, rough):
        copytree(two_runs("touched").root, layers.root)
    last(calm)
    with monkeypatch.context() as patch:
        CRASHES[crash](patch)
        with pytest.raises(Crash):
            last(rough)
    if crash == "silver not moved in":
        assert compact_layers(spark, rough, at(60), everything=True)["silver"]
    last(rough)
    assert tables(spark, rough) == tables(spark, calm)


def test_any_number_of_days_is_exact(spark):
    df = spark.sql("SELECT explode(sequence(DATE '1900-01-01', DATE '1999-12-31')) AS date UNION ALL SELECT NULL")
    wanted = [date(1900, 1, 2), date(1905, 1, 5)]
    assert df.where(days.on_days(wanted)).count() == 2
    assert df.where(days.on_days([*wanted, None])).count() == 3
    assert df.where(days.on_days([])).count() == 0
    many = [date(1900, 1, 1) + timedelta(days=n) for n in range(0, 36_524) if n % 3]
    assert len(many) > 24_000
    got = df.where(days.on_days(many))
    assert got.count() == len(many) and got.where("date = DATE '1900-01-04'").isEmpty()


HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def land(layers, name, *lines):
    path = Path(layers.landing) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(f"{line}\n" for line in lines))


def test_files_go_to_processed_with_their_batch(spark, folder, monkeypatch):
    layers = Layers(folder)
    land(layers, "a.csv", "2024-05-01 00:00:00,1,5,90,1", "2024-05-01 01:00:00,1,5,90,2,EXTRA", ",1,5,90,3")
    land(layers, "b c.csv", "2024-05-01 02:00:00,1,5,90,4")
    with monkeypatch.context() as patch:
        crash_after(patch, bronze_plan, "load_arrivals")
        with pytest.raises(Crash):
            bronze_plan.bronze(spark, layers, at(0))
    land(layers, "later.csv", "2024-05-01 03:00:00,1,5,90,5")
    assert bronze_plan.bronze(spark, layers, at(0)) is False
    processed = Path(layers.processed) / batch_name(at(0))
    assert sorted(str(p.relative_to(processed)) for p in processed.rglob("*.csv")) == ["a.csv", "b c.csv"]
    assert [p.name for p in Path(layers.landing).rglob("*.csv")] == ["later.csv"]
    assert bronze_plan.bronze(spark, layers, at(1))
    assert bronze_plan.bronze(spark, layers, at(2))
    rows = read_bronze(spark, layers).collect()
    assert Counter(r.source_file.rsplit("/", 1)[1] for r in rows) == {"a.csv": 3, "b%20c.csv": 1, "later.csv": 1}
    silver(spark, layers)
    assert [p for _, _, p in powers(spark, layers)] == [1.0, 4.0, 5.0]
    reasons = sorted(r.reject_reason for r in read_error_log(spark, layers).collect())
    assert reasons == ["the line does not have the declared fields", "timestamp is not a valid timestamp"]


def test_redelivered_and_changed_files_are_told_apart(spark, folder, monkeypatch):
    layers = Layers(folder)
    first, second, third = (f"2024-05-01 0{hour}:00:00,1,5,90,{hour + 1}" for hour in range(3))

    def load(number, **named):
        return bronze_plan.bronze(spark, layers, at(number), "append", skip_redelivered=True, **named)

    land(layers, "a.csv", first, second)
    land(layers, "b c.csv", third)
    Path(layers.landing, "empty.csv").write_text("")
    assert load(0)
    land(layers, "again.csv", second, first)
    land(layers, "b c.csv", third + "5")
    land(layers, "c.csv", third + "6")
    land(layers, "d.csv", third + "6")
    Path(layers.landing, "none.csv").write_text("")
    with monkeypatch.context() as patch:
        crash_after(patch, bronze_plan, "load_arrivals", 0)
        with pytest.raises(Crash):
            load(1)
    assert load(1)
    land(layers, "a.csv", first, second)
    assert load(2)
    assert not list(Path(layers.landing).rglob("*.csv"))
    kinds = [(row.batch_id, row.path, row.kind) for row in read_registry(spark, layers.landed_files).collect()]
    assert sorted(kinds) == [
        (batch_name(at(0)), "a.csv", "new"),
        (batch_name(at(0)), "b c.csv", "new"),
        (batch_name(at(0)), "empty.csv", "new"),
        (batch_name(at(1)), "again.csv", "redelivered"),
        (batch_name(at(1)), "b c.csv", "changed"),
        (batch_name(at(1)), "c.csv", "new"),
        (batch_name(at(1)), "d.csv", "redelivered"),
        (batch_name(at(1)), "none.csv", "new"),
        (batch_name(at(2)), "a.csv", "redelivered"),
    ]
    powers_held = sorted(row.power_output for row in read_bronze(spark, layers).collect())
    assert powers_held == ["1", "2", "3", "35", "36"]


def test_reads_of_days_list_their_folders_only(spark, folder):
    layers = Layers(folder)
    run(spark, layers, [[reading(day, 0) for day in range(1, 9)]])
    table = swap.silver_table(spark, layers)
    wanted = [date(2024, 5, 2), date(2024, 5, 7), date(2024, 6, 1), None]
    got = table.on(wanted)
    assert sorted(name.split("date=")[1][:10] for name in got.inputFiles()) == ["2024-05-02", "2024-05-07"]
    assert sorted(row.date.day for row in got.collect()) == [2, 7]
    assert table.on([]).count() == 0 and not table.is_new()
    assert swap.silver_table(spark, Layers(f"{folder}/none")).is_new()
