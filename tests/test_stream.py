from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

from strataflux.plans.bronze import read_bronze
from strataflux.plans.gold import read_gold
from strataflux.streaming import arrivals
from strataflux.sources.tables import Layers

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"


def land(layers, name, *lines):
    folder = Path(layers.landing)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f"{line}\n" for line in lines))


def clock():
    start = datetime(2024, 6, 1, tzinfo=timezone.utc)
    ticks = (start + timedelta(hours=n) for n in range(100))
    return lambda: next(ticks)


def run(spark, layers, ticking, **kwargs):
    arrivals.start_arrivals(spark, layers, clock=ticking, **kwargs).awaitTermination()


def stamps(spark, layers):
    return Counter((r.turbine_id, r.load_datetime.hour) for r in read_bronze(spark, layers).collect())


def test_runs_take_new_files_only_and_archive_finished_ones(spark, folder):
    layers, ticking = Layers(folder), clock()
    land(layers, "a.csv", "2024-05-01 00:00:00,1,5,90,1")
    run(spark, layers, ticking)
    run(spark, layers, ticking)
    assert (Path(layers.landing) / "a.csv").exists()
    land(layers, "b.csv", "2024-05-01 00:00:00,1,5,90,2", "2024-05-01 00:00:00,2,5,90,3")
    run(spark, layers, ticking)
    assert stamps(spark, layers) == {("1", 0): 1, ("2", 1): 1}
    assert not (Path(layers.landing) / "a.csv").exists()
    assert [p.name for p in Path(layers.processed).rglob("*.csv")] == ["a.csv"]
    assert (Path(layers.landing) / "b.csv").exists()


def test_files_can_be_taken_in_several_batches(spark, folder):
    layers = Layers(folder)
    for number in range(3):
        land(layers, f"{number}.csv", f"2024-05-01 00:00:00,{number},5,90,1")
    run(spark, layers, clock(), max_files=1)
    assert {hour for _, hour in stamps(spark, layers)} == {0, 1, 2}


def test_replayed_batch_keeps_its_load_time(spark, folder, monkeypatch):
    """The batch is stored but the stream dies before it can note that."""
    layers, ticking = Layers(folder), clock()
    land(layers, "a.csv", "2024-05-01 00:00:00,1,5,90,1")
    real = arrivals.load_arrivals

    def dying(*args):
        real(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "load_arrivals", dying)
        try:
            run(spark, layers, ticking)
        except Exception as error:  # noqa: BLE001 - the stream wraps what its batch raised
            assert "lost" in str(error)
    run(spark, layers, ticking)
    assert stamps(spark, layers) == {("1", 0): 1}


def test_clock_that_stands_still_does_not_hide_batches(spark, folder):
    layers = Layers(folder)
    still = datetime(2024, 6, 1, tzinfo=timezone.utc)
    for number in (1, 2):
        land(layers, f"{number}.csv", f"2024-05-01 00:00:00,{number},5,90,1")
        arrivals.process_arrivals(spark, layers, clock=lambda: still)
    assert sorted(r.turbine_id for r in read_gold(spark, layers).collect()) == [1, 2]


def test_old_files_are_read(spark, folder):
    """A file dated a month before the newest one read is new all the same."""
    layers, ticking = Layers(folder), clock()
    for number, age in ((1, 0), (2, 30), (3, 0)):
        land(layers, f"{number}.csv", f"2024-05-01 00:00:00,{number},5,90,1")
        path = Path(layers.landing) / f"{number}.csv"
        os.utime(path, (path.stat().st_mtime - age * 86_400,) * 2)
        run(spark, layers, ticking)
    assert sorted(turbine for turbine, _ in stamps(spark, layers)) == ["1", "2", "3"]
