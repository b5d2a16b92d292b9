"""Raw files: names, columns, types and missing values."""

import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from pyarrow import parquet
from pyspark.errors import AnalysisException

from wayfare.schemas import RAW_TRIPS, RAW_ZONES, TRIP_RENAMES
from wayfare.sources import ingest
from wayfare.sources.ingest import align, read_trips, read_zones

TIMES = "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz"
MOMENT = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("trips")
    first = spark.createDataFrame(
        [(2, MOMENT, MOMENT, float("nan"), 1.25, 7, 8, 0.5, "dropped")],
        f"VendorID int, {TIMES}, passenger_count double, trip_distance double, "
        "PULocationID int, DOLocationID int, Airport_fee double, unknown string",
    )
    second = spark.createDataFrame(
        [(1, MOMENT, MOMENT, 3, 2.5)],
        f"VendorID long, {TIMES}, passenger_count long, trip_distance double",
    )
    first.coalesce(1).write.parquet(str(path / "a"))
    second.coalesce(1).write.parquet(str(path / "b"))
    return path


def test_trips_are_aligned(spark, folder):
    trips = read_trips(spark, str(folder / "a"))
    assert trips.columns == RAW_TRIPS.names
    assert [f.dataType for f in trips.schema.fields] == [f.dataType for f in RAW_TRIPS.fields]
    row = trips.first()
    assert (row.vendor_id, row.pu_location_id, row.do_location_id) == (2, 7, 8)
    assert row.passenger_count is None  # NaN
    assert (row.trip_distance, row.airport_fee) == (1.25, 0.5)
    assert row.tip_amount is None and row.payment_type is None  # not in the file
    assert row.source_file.endswith(".parquet")


def test_files_of_different_types(spark, folder):
    trips = read_trips(spark, [str(folder / "a"), str(folder / "b")])
    assert sorted(row.vendor_id for row in trips.collect()) == [1, 2]
    assert sorted(str(row.passenger_count) for row in trips.collect()) == ["3.0", "None"]


def test_wildcard_reads_all_matches(spark, folder):
    assert read_trips(spark, str(folder / "a" / "*.parquet")).count() == 1


def test_wildcard_keeps_columns_that_only_some_files_have(spark, tmp_path):
    """A column that only the later file has, one whose type differs, and both at once."""
    for name, columns, row in (
        ("2024-12", "VendorID long, fare_amount double", (1, 2.5)),
        ("2025-01", "VendorID int, fare_amount double, cbd_congestion_fee double", (2, 3.5, 0.75)),
        ("2025-02", "VendorID long, fare_amount long, cbd_congestion_fee double", (3, 4, 1.25)),
    ):
        spark.createDataFrame([row], columns).coalesce(1).write.parquet(str(tmp_path / name))
    expected = {1: ("2.5", "None"), 2: ("3.5", "0.75"), 3: ("4", "1.25")}
    for vendors, pattern in ((expected, "*"), ([1, 2], "202[45]-{12,01}"), ([2, 3], "2025-*")):
        rows = read_trips(spark, str(tmp_path / pattern)).collect()
        got = {r.vendor_id: (r.fare_amount, r.cbd_congestion_fee) for r in rows}
        assert got == {
            v: tuple(None if x == "None" else float(x) for x in expected[v]) for v in vendors
        }


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """1,000 files of two types, in turn."""
    folder = tmp_path_factory.mktemp("many files")  # with a space
    for n in range(1_000):
        kind = pa.int64() if n % 2 else pa.int32()
        table = pa.table({"VendorID": pa.array([n], kind), "fare_amount": pa.array([n / 4], pa.float64())})
        parquet.write_table(table, folder / f"{n:04}.parquet")
    return str(folder)


def jobs_of(spark, action):
    """What an action gives, and how many jobs it took."""
    spark.sparkContext.setJobGroup("counted", "", False)
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
        found = action()
        return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_many_files_of_two_types_take_few_jobs(spark, many_files):
    trips, jobs = jobs_of(spark, lambda: read_trips(spark, many_files))
    assert jobs <= 8
    some, fewer = jobs_of(spark, lambda: read_trips(spark, f"{many_files}/000[0-3].parquet"))
    assert jobs <= fewer + 2  # Spark lists a thousand files by a job, once for each look at them
    assert sorted((r.vendor_id, r.fare_amount) for r in trips.collect()) == [(n, n / 4) for n in range(1_000)]
    assert some.count() == 4


def test_footers_are_read_by_workers_without_the_package(many_files, tmp_path):
    """In a session whose workers do not find it."""
    root = str(Path(ingest.__file__).resolve().parents[2])
    code = f"""
import sys
sys.path.insert(0, {root!r})
from wayfare.session import local_session
from wayfare.sources.ingest import read_trips
print("rows", read_trips(local_session(2), {many_files!r} + "/000*.parquet").count())
"""
    kept = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=kept, capture_output=True, text=True)
    assert "rows 10" in done.stdout, done.stderr[-2000:]


def test_files_that_only_spark_can_open(spark, many_files, monkeypatch):
    def nothing(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(batch.num_rows, pa.string())], ["file", "columns"])

    monkeypatch.setattr(ingest, "_footer_reader", lambda: nothing)
    trips = read_trips(spark, f"{many_files}/000*.parquet")
    assert sorted(r.vendor_id for r in trips.collect()) == list(range(10))


def test_measures_keep_their_printed_value(spark):
    """Floats, texts and decimals become the double that is printed like them; NaN is no value."""
    table = spark.sql(
        "SELECT 0.1F AS fare_amount, '2.675' AS tip_amount, 'NaN' AS extra, 1.005BD AS tolls_amount, "
        "double('Infinity') AS total_amount, 123456789012345D AS mta_tax, float('NaN') AS airport_fee"
    )
    row = align(table, RAW_TRIPS).first()
    assert (row.fare_amount, row.tip_amount, row.tolls_amount) == (0.1, 2.675, 1.005)
    assert (row.total_amount, row.mta_tax) == (float("inf"), 123456789012345.0)
    assert row.extra is None and row.airport_fee is None


def test_two_columns_of_one_name_are_an_error(spark):
    table = spark.createDataFrame([(1, 2)], "VendorID int, vendor_id int")
    with pytest.raises(ValueError, match="both vendor_id"):
        align(table, RAW_TRIPS, TRIP_RENAMES)


def test_no_match_is_an_error(spark, folder):
    with pytest.raises(AnalysisException):
        read_trips(spark, str(folder / "none*.parquet"))


def test_scan_reads_only_used_columns(spark, folder):
    used = read_trips(spark, str(folder / "a")).select("vendor_id", "source_file")
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert plan.rstrip().endswith("ReadSchema: struct<VendorID:int>")


def test_zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        "LocationID,Borough,Zone,service_zone,extra\n"
        '1,EWR,"Newark ""A"", main",EWR,x\n'
        "2,N/A,NA,Boro Zone,x\n"
        "264,Unknown,,null,x\n"
        ',"two\nlines",b,c,x\n'
    )
    zones = read_zones(spark, str(path))
    assert zones.columns == RAW_ZONES.names
    got = {row.location_id: tuple(row)[1:] for row in zones.collect()}
    assert got == {
        1: ("EWR", 'Newark "A", main', "EWR", "zones.csv"),
        2: (None, None, "Boro Zone", "zones.csv"),
        264: ("Unknown", None, None, "zones.csv"),
        None: ("two\nlines", "b", "c", "zones.csv"),
    }
