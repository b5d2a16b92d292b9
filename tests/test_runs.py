"""Which runs are kept, and for whom."""

from datetime import timedelta

import pytest

from wayfare.plans import layers, runs
from wayfare.plans.layers import StoredLayers
from wayfare.plans.refresh import publish, refresh
from wayfare.standin import trips as standin


@pytest.fixture
def run(spark, tmp_path):
    """Make a run with one small table, in any state."""

    def make(state=runs.SUCCESS):
        made = runs.Run.start(spark, str(tmp_path), "x")
        spark.range(3).write.parquet(runs.table_path(made.folder, "bronze.a"))
        if state == runs.SUCCESS:
            made.succeed()
        elif state == runs.FAILED:
            made.fail("bronze.a", ValueError("no"))
        return made.run_id

    return make


def left(root):
    return sorted(p.name for p in (root / "runs").iterdir())


def test_the_last_runs_that_succeeded_stay(spark, tmp_path, run):
    ids = [run(state) for state in (runs.SUCCESS, runs.FAILED, runs.SUCCESS, runs.SUCCESS, runs.FAILED)]
    assert runs.retain(spark, str(tmp_path), keep=2) == sorted([ids[0], ids[1], ids[4]])
    assert left(tmp_path) == sorted([ids[2], ids[3]])
    assert runs.latest_run(spark, str(tmp_path)) == ids[3]
    assert runs.retain(spark, str(tmp_path), keep=2) == []
    assert runs.read_log(spark, str(tmp_path), runs.RUN_LOG).count() == 10
    with pytest.raises(ValueError):
        runs.retain(spark, str(tmp_path), keep=0)


def test_runs_under_way_stay_until_they_are_abandoned(spark, tmp_path, run):
    first, second = run(runs.STARTED), run()
    assert runs.retain(spark, str(tmp_path), keep=1) == []
    assert runs.retain(spark, str(tmp_path), keep=1, abandoned=timedelta(0)) == [first]
    assert left(tmp_path) == [second]


def test_a_leased_run_stays(spark, tmp_path, run):
    old = run()
    with runs.leased(spark, str(tmp_path)) as held:
        assert held == old
        run()
        assert runs.retain(spark, str(tmp_path), keep=1) == []
        assert spark.read.parquet(runs.table_path(runs.run_folder(str(tmp_path), old), "bronze.a")).count() == 3
    assert runs.retain(spark, str(tmp_path), keep=1) == [old]
    assert not (tmp_path / "leases" / old).exists()
    with pytest.raises(runs.ExpiredRunError):
        with runs.leased(spark, str(tmp_path), old):
            pass


def test_a_lease_ends(spark, tmp_path, run):
    old = run()
    with runs.leased(spark, str(tmp_path), length=timedelta(microseconds=1)):
        run()
        assert runs.retain(spark, str(tmp_path), keep=1) == [old]


def test_a_lease_taken_while_cleaning_keeps_the_run(spark, tmp_path, run, monkeypatch):
    """A reader that comes between the look at leases and the deletion."""
    old, new = run(), run()
    whole, taken = runs.move, []

    def between(spark, source, target):
        if not taken:
            taken.append(runs.touch(spark, f"{tmp_path}/leases/{old}/99991231T000000000000-x"))
        whole(spark, source, target)

    monkeypatch.setattr(runs, "move", between)
    assert runs.retain(spark, str(tmp_path), keep=1) == []
    assert left(tmp_path) == sorted([old, new])


def test_what_a_cleaning_left_is_deleted(spark, tmp_path, run):
    old, new = run(), run()
    (tmp_path / "runs" / old).rename(tmp_path / "runs" / f".deleting-{old}")
    assert runs.retain(spark, str(tmp_path), keep=1) == []
    assert left(tmp_path) == [new]


def test_reader_of_an_old_refresh(spark, sf_dir, tmp_path):
    root, raw = str(tmp_path), standin.layers(spark, sf_dir)
    refresh(raw.raw_trips, raw.raw_zones, root)
    with StoredLayers.leased(spark, root) as old:
        before = sorted(map(tuple, old.daily.collect()))
        refresh(raw.raw_trips.where("pu_location_id > 5"), raw.raw_zones, root)
        assert runs.retain(spark, root, keep=1) == []
        assert sorted(map(tuple, old.daily.collect())) == before
    assert len(runs.retain(spark, root, keep=1)) == 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST"):
        old.trips.collect()
    publish(spark, root)
    assert spark.table("silver.taxi_trips_cleaned").count() == StoredLayers.read(spark, root).trips.count()
    assert set(layers.STORED.values()) >= {layers.TRIPS}
