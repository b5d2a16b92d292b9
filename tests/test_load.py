"""The load in one pass: one classified scan, duplicates without a sort, counts from the writes."""

import re
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wayfare.plans import checks, layers, refresh as module, runs, silver
from wayfare.plans.layers import Layers
from wayfare.plans.refresh import refresh
from wayfare.standin import trips as standin


def counted(table):
    return Counter(tuple(row) for row in table.collect())


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_paths(spark):
    name = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, "2000")
    yield
    spark.conf.set(name, before)


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return standin.layers(spark, sf_dir)


@pytest.fixture(scope="module")
def load(lazy, tmp_path_factory):
    """A refresh, with the plans of all tables it writes by the end of their path."""
    plans = {}
    whole = module.write_counted

    def watched(table, path, *args, **options):
        plans[path.rsplit("/", 1)[-1]] = plan_of(table)
        return whole(table, path, *args, **options)

    root = str(tmp_path_factory.mktemp("load"))
    module.write_counted = watched
    try:
        return root, refresh(lazy.raw_trips, lazy.raw_zones, root), plans
    finally:
        module.write_counted = whole


def test_raw_trips_are_scanned_once(load):
    _, _, plans = load
    bronze = layers.RAW_TRIPS.split(".")[1]
    scans = {name: len(re.findall(rf"FileScan [^\n]*{bronze}", text)) for name, text in plans.items()}
    assert {name: n for name, n in scans.items() if n} == {"routed": 1}
    for name in (layers.TRIPS, layers.ISSUES):
        text = plans[name.split(".")[1]]
        found = re.findall(r"FileScan [^\n]*/routed\][^\n]*PartitionFilters: \[isnotnull\(route#\d+\), \(route#\d+ = (\w+)\)\]", text)
        assert found == (["rejected"] if name == layers.ISSUES else ["keyed", "single"])


def test_duplicates_take_no_sort(load, lazy):
    _, _, plans = load
    assert "SortAggregate" not in plans[layers.TRIPS.split(".")[1]]
    assert "SortAggregate" not in plan_of(lazy.trips)
    assert plan_of(lazy.trips).count("HashAggregate") >= 2


def test_routed_trips_are_removed(load):
    root, _, _ = load
    assert not list(Path(root).glob("runs/*/routed"))


def test_logged_counts_are_those_of_the_tables(spark, load):
    root, stored, _ = load
    log = runs.read_log(spark, root, runs.LOAD_LOG).drop("run_id", "message", "logged_at")
    assert counted(log) == counted(checks.load_audit(stored))


def test_conservation_by_tables_and_by_plans(lazy, load):
    _, stored, _ = load
    found = checks.row_conservation(stored).first()
    assert found == checks.row_conservation(lazy).first()
    assert found["status"] == "SUCCESS" and found["dropped_rows"] > 0


def test_conservation_scans_trips_twice_and_shuffles_them_once(load):
    _, stored, _ = load
    plain = Layers(stored.raw_trips, stored.raw_zones)
    plan = plan_of(checks.row_conservation(plain))
    bronze = layers.RAW_TRIPS.split(".")[1]
    # The third scan is that of trips without vendor, which skip the shuffle.
    assert len(re.findall(rf"FileScan [^\n]*{bronze}", plan)) == 3
    assert len(re.findall(r"Exchange hashpartitioning\(pickup_datetime", plan)) == 1


def test_lost_rows_are_noticed_in_the_table_check(lazy, load):
    _, stored, _ = load
    short = layers.StoredLayers(
        {name: getattr(stored, attribute) for attribute, name in layers.STORED.items()}
        | {layers.TRIPS: stored.trips.where("pickup_hour <> 12")}
    )
    assert checks.row_conservation(short).first()["status"] == "FAILED"


@pytest.fixture(scope="module")
def copies(lazy):
    """Valid trips, each three times with other fares, tips and codes, some beyond the packed form."""
    valid = silver.valid_trips(lazy.raw_trips, lazy.zones, lazy.zone_size).limit(60)
    step = F.col("step")
    return valid.crossJoin(lazy.raw_trips.sparkSession.range(3).select(F.col("id").alias("step"))).withColumns(
        {
            "fare_amount": F.when(F.col("pu_location_id") % 2 == 0, F.lit(7.25)).otherwise(10.0 - step),
            "tip_amount": F.lit(9_999_999_999.99) - F.when(F.col("do_location_id") % 2 == 0, step).otherwise(0),
        }
    ).drop("step")


@pytest.mark.parametrize("largest", [6, silver.MOST_CODE - 1, silver.MOST_CODE, 2**63 - 1])
def test_any_payment_code_gives_the_least_trip(lazy, copies, largest):
    code = F.when(F.col("pu_location_id") % 3 == 0, F.lit(largest)).otherwise(F.lit(-largest))
    raw = copies.withColumn("payment_type", code + F.when(F.col("fare_amount") > 9, -F.signum(code)).otherwise(0).cast("long"))
    some = Layers(raw, lazy.raw_zones)
    assert some.codes_fit is (largest < silver.MOST_CODE)
    rounded = silver.rounded_trips(silver.valid_trips(raw, some.zones, some.zone_size))
    least = {}
    for row in rounded.collect():
        key = tuple(row[name] for name in some.profile.trip_key)
        own = (row["fare_amount"], row["tip_amount"], row["payment_type"])
        least[key] = min(own, least.get(key, own))
    found = some.trips.where("vendor_id IS NOT NULL")
    assert ("SortAggregate" in plan_of(found)) is not some.codes_fit
    rows = {
        tuple(r[name] for name in some.profile.trip_key): (r["fare_amount"], r["tip_amount"], r["payment_type"])
        for r in found.collect()
    }
    assert rows == {k: v for k, v in least.items() if k[-1] is not None}
    assert any(v[1] > Decimal("9999999990") for v in rows.values())


def test_load_with_codes_beyond_the_packed_form(spark, lazy, tmp_path):
    odd = F.when(F.col("pu_location_id") == 3, F.lit(2**62)).otherwise(F.col("payment_type"))
    raw = lazy.raw_trips.withColumn("payment_type", odd)
    stored = refresh(raw, lazy.raw_zones, str(tmp_path))
    direct = Layers(raw, lazy.raw_zones)
    assert not direct.codes_fit
    assert counted(stored.trips.select(*direct.trips.columns)) == counted(direct.trips)
    assert stored.trips.where(F.col("payment_type") == 2**62).count() > 0
