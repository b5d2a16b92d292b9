"""Rules, quarantine, duplicates and zones on literal rows."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wayfare.operators.lookup import DuplicateKeyError, LookupSize, measure_lookup
from wayfare.plans import silver
from wayfare.plans.layers import Layers
from wayfare.profile import TripProfile
from wayfare.schemas import RAW_TRIPS, RAW_ZONES
from wayfare.sources.ingest import align

START = datetime(2026, 1, 5, 8)
GOOD = {
    "vendor_id": 1,
    "tpep_pickup_datetime": START,
    "tpep_dropoff_datetime": START + timedelta(minutes=10),
    "passenger_count": "1",
    "trip_distance": "2.5",
    "pu_location_id": 1,
    "do_location_id": 2,
    "payment_type": 1,
    "fare_amount": "10",
    "tip_amount": "2",
    "total_amount": "12.5",
    "source_file": "x.parquet",
}
SCHEMA = (
    "vendor_id int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count string, trip_distance string, pu_location_id int, do_location_id int, "
    "payment_type long, fare_amount string, tip_amount string, total_amount string, source_file string"
)


def raw(spark, *changes):
    rows = [tuple({**GOOD, **change}.values()) for change in changes]
    return align(spark.createDataFrame(rows, SCHEMA), RAW_TRIPS)


def zones(spark, *rows):
    rows = rows or ((1, "A", "a", "s"), (2, "B", "b", "s"))
    table = spark.createDataFrame(rows, "location_id int, borough string, zone string, service_zone string")
    return align(table, RAW_ZONES)


def layers(spark, *changes, profile=None):
    return Layers(raw(spark, *changes), zones(spark), profile or TripProfile())


CASES = {
    "missing_datetime": {"tpep_dropoff_datetime": None, "fare_amount": "-1"},
    "invalid_duration": {"tpep_dropoff_datetime": START, "passenger_count": "0"},
    "invalid_passenger_count": {"passenger_count": None, "trip_distance": "0"},
    "invalid_trip_distance": {"trip_distance": "-1", "fare_amount": "-1"},
    "negative_fare": {"fare_amount": None, "tip_amount": "-1"},
    "negative_tip": {"tip_amount": "-0.01", "total_amount": None},
    "negative_total_amount": {"total_amount": None, "pu_location_id": 99},
    "unknown_pickup_location": {"pu_location_id": None, "do_location_id": 99},
    "unknown_dropoff_location": {
        "do_location_id": 99,
        "tpep_pickup_datetime": START - timedelta(days=40),
    },
    "outside_january_2026": {"tpep_pickup_datetime": datetime(2025, 12, 31, 23, 59), "trip_distance": "0.004"},
    "rounds_to_zero": {"trip_distance": "0.004"},
}


@pytest.mark.parametrize("size", [LookupSize(2, 100), LookupSize(2, 100, max_rows=1)])
def test_first_failing_rule_wins(spark, size):
    """With the zone list broadcast, and with it joined by shuffle."""
    changes = list(CASES.values()) + [{}]
    classified = silver.classify(
        raw(spark, *changes).withColumn("n", F.monotonically_increasing_id()),
        zones(spark),
        size,
    )
    got = [row.error_type for row in classified.orderBy("n").collect()]
    assert got == list(CASES) + [None]
    valid = silver.valid_trips(raw(spark, *changes), zones(spark), size)
    assert valid.count() == 1


def test_zero_money_is_valid(spark):
    change = {"fare_amount": "0", "tip_amount": "0", "total_amount": "0"}
    assert layers(spark, change).trips.count() == 1


def test_nan_is_not_positive(spark):
    rows = [(1, START, START + timedelta(minutes=1), float("nan"), 1.0, 1, 2, 1, 1.0, 1.0, 1.0)]
    table = spark.createDataFrame(
        rows,
        "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double, pu_location_id int, do_location_id int, "
        "payment_type long, fare_amount double, tip_amount double, total_amount double",
    )
    issues = Layers(align(table, RAW_TRIPS, {"VendorID": "vendor_id"}), zones(spark)).issues
    assert [row.error_type for row in issues.collect()] == ["invalid_passenger_count"]


def test_window_is_half_open(spark):
    edges = [
        datetime(2026, 1, 1),
        datetime(2026, 1, 31, 23, 59, 59, 999999),
        datetime(2026, 2, 1),
    ]
    changes = [
        {"tpep_pickup_datetime": edge, "tpep_dropoff_datetime": edge + timedelta(minutes=5)} for edge in edges
    ]
    both = layers(spark, *changes)
    assert sorted(row.pickup_datetime for row in both.trips.collect()) == edges[:2]
    assert [row.pickup_datetime for row in both.issues.collect()] == edges[2:]


def test_another_window(spark):
    profile = TripProfile(datetime(2025, 1, 1), datetime(2025, 2, 1), "outside_window")
    assert layers(spark, {}, profile=profile).issues.first().error_type == "outside_window"


@pytest.mark.parametrize(
    "change",
    [
        {"trip_distance": "0.004"},
        {"passenger_count": "0.4"},
        {"tpep_dropoff_datetime": START + timedelta(milliseconds=200)},
    ],
)
def test_rounds_to_zero(spark, change):
    default = layers(spark, change)
    assert default.trips.count() == 0
    assert default.issues.first().error_type == "rounds_to_zero"
    with pytest.raises(Exception, match="rounds to zero"):
        layers(spark, change, profile=TripProfile(strict=True)).trips.collect()


def test_least_values_that_do_not_round_to_zero(spark):
    change = {
        "trip_distance": "0.005",
        "passenger_count": "0.5",
        "tpep_dropoff_datetime": START + timedelta(milliseconds=300),
    }
    (row,) = layers(spark, change).trips.collect()
    assert (row.trip_distance, row.passenger_count, row.trip_duration_minutes) == (
        Decimal("0.01"),
        1,
        Decimal("0.01"),
    )


@pytest.mark.parametrize(
    "change, reason",
    [
        ({"fare_amount": "-0.0000004"}, "negative_fare"),
        ({"trip_distance": "0.0049999"}, "rounds_to_zero"),
        ({"trip_distance": "0.0000004"}, "rounds_to_zero"),
        ({"fare_amount": "2e12", "passenger_count": "0"}, "invalid_passenger_count"),
        ({"fare_amount": "2e12"}, "exceeds_range"),
        ({"fare_amount": "Infinity"}, "exceeds_range"),
        ({"fare_amount": "-Infinity"}, "negative_fare"),
        ({"total_amount": "9999999999.995"}, "exceeds_range"),
        ({"passenger_count": "2147483647.5"}, "exceeds_range"),
        ({"trip_distance": "1e300", "passenger_count": "0.4"}, "exceeds_range"),
    ],
)
def test_raw_values_meet_the_rules_unrounded(spark, change, reason):
    both = layers(spark, change)
    (row,) = both.issues.collect()
    assert row.error_type == reason
    assert {name: getattr(row, name) for name in change} == {k: float(v) for k, v in change.items()}
    assert both.trips.count() == 0


@pytest.mark.parametrize(
    "raw_value, cleaned",
    [
        ("1.0049999", "1.00"),
        ("1.005", "1.01"),
        ("2.675", "2.68"),
        ("0.0000004", "0.00"),
        ("9999999999.99", "9999999999.99"),
    ],
)
def test_money_is_rounded_once(spark, raw_value, cleaned):
    (row,) = layers(spark, {"fare_amount": raw_value}).trips.collect()
    assert row.fare_amount == Decimal(cleaned)


def test_strict_stops_on_values_without_room(spark):
    with pytest.raises(Exception, match="too large"):
        layers(spark, {"fare_amount": "2e12"}, profile=TripProfile(strict=True)).trips.collect()


def test_strict_keeps_good_trips(spark):
    assert layers(spark, {}, profile=TripProfile(strict=True)).trips.count() == 1


def test_issue_keeps_raw_values_and_reason(spark):
    row = layers(spark, {"trip_distance": "-1.2345"}).issues.first()
    assert row.trip_distance == -1.2345
    assert row.error_description == "Record rejected during bronze to silver validation"
    assert row.source_file == "x.parquet"


def test_duplicates_by_vendor(spark):
    """Copies fold, except where the vendor is unknown: NULLs are distinct."""
    trips = layers(spark, {}, {}, {"vendor_id": None}, {"vendor_id": None}).trips
    assert sorted(row.vendor_id or 0 for row in trips.collect()) == [0, 0, 1]


def test_duplicates_are_found_after_rounding(spark):
    assert layers(spark, {"trip_distance": "1.001"}, {"trip_distance": "1.004"}).trips.count() == 1


def test_duplicate_with_least_values_stays(spark):
    changes = [
        {"fare_amount": "9", "tip_amount": "5", "payment_type": 2},
        {"fare_amount": "9", "tip_amount": "4", "payment_type": 3},
        {"fare_amount": "10", "tip_amount": "1", "payment_type": 1},
    ]
    for order in (changes, changes[::-1]):
        (row,) = layers(spark, *order).trips.collect()
        assert (row.fare_amount, row.tip_amount, row.payment_type) == (9, 4, 3)


def test_missing_payment_is_other(spark):
    row = layers(spark, {"payment_type": None}).trips.first()
    assert (row.payment_type, row.payment_label) == (0, "Other")


def test_zone_cleaning(spark):
    rows = [
        (1, " ", None, " Queens "),
        (1, "", None, "Queens"),
        (2, "B", "b", ""),
        (None, "X", "X", "X"),
    ]
    clean = silver.clean_zones(zones(spark, *rows)).orderBy("location_id").collect()
    assert [tuple(row) for row in clean] == [
        (1, "Unknown", "Unknown", "Queens"),
        (2, "B", "b", "Unknown"),
    ]


def test_two_spellings_of_one_zone_are_refused(spark):
    clean = silver.clean_zones(zones(spark, (1, "A", "a", "s"), (1, "A", "b", "s")))
    with pytest.raises(DuplicateKeyError):
        measure_lookup(clean, "location_id")


def test_lookup_size(spark):
    clean = silver.clean_zones(zones(spark))
    size = measure_lookup(clean, "location_id")
    assert size.rows == 2 and 0 < size.bytes < 200 and size.fits
    assert not measure_lookup(clean, "location_id", max_rows=1).fits
    assert not measure_lookup(clean, "location_id", max_bytes=10).fits
