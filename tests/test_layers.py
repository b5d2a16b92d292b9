"""The layers as a whole: refresh, names, exports and what must hold between them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from wayfare.__main__ import main
from wayfare.operators import audit
from wayfare.operators.lookup import LookupSize
from wayfare.plans import checks, exports, gold, layers, questions, runs, silver
from wayfare.plans.layers import StoredLayers
from wayfare.plans.refresh import LostRowsError, publish, refresh
from wayfare.profile import TripProfile
from wayfare.sources.sinks import cleaned, export_reports, shared_folder, stored, write_csv
from wayfare.standin import trips as standin


def counted(table):
    return Counter(tuple(row) for row in table.collect())


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return standin.layers(spark, sf_dir)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("layers"))


@pytest.fixture(scope="module")
def built(lazy, root):
    return refresh(lazy.raw_trips, lazy.raw_zones, root)


MARTS = ("daily", "hourly", "zone", "payment", "route", "zone_view", "daily_view")


@pytest.mark.parametrize("mart", MARTS)
def test_stored_marts_equal_direct_ones(lazy, built, mart):
    """Sums added up in two steps give the same marts, to the last digit."""
    assert counted(getattr(built, mart)) == counted(getattr(lazy, mart))


def test_stored_rows_equal_direct_ones(lazy, built):
    assert counted(built.trips.select(*lazy.trips.columns)) == counted(lazy.trips)
    assert counted(built.issues.drop("issue_id", "logged_at")) == counted(lazy.issues)
    assert counted(built.zones) == counted(lazy.zones)


def test_every_raw_trip_is_accounted_for(built):
    assert checks.row_conservation(built).first().status == "SUCCESS"


def test_marts_add_up(built):
    trips = built.trips.count()
    for mart in (built.daily, built.hourly, built.payment, built.route):
        assert mart.agg(F.sum("total_trips")).first()[0] == trips
    assert built.zone.agg(F.sum("total_pickup_trips")).first()[0] == trips
    assert built.zone_view.agg(F.sum("total_dropoff_trips")).first()[0] == trips
    assert built.enriched_view.count() == trips
    last = questions.running_revenue(built).agg(F.max("running_total_revenue")).first()[0]
    assert last == built.trips.agg(F.sum("total_amount")).first()[0]


def test_zone_without_trips(built):
    row = built.zone.where("location_id = 24").first()
    assert row.total_pickup_trips == 0
    assert row.total_revenue is None and row.avg_tip is None and row.avg_distance is None


def test_constraints_hold(built):
    keys = checks.primary_keys(built).collect()
    assert {row.violations for row in keys} == {0} and len(keys) == 8
    assert {row.violations for row in checks.foreign_keys(built).collect()} == {0}
    assert {row.violations for row in checks.required_values(built).collect()} == {0}
    assert {row.violations for row in checks.trip_ranges(built).collect()} == {0}
    assert checks.natural_key(built).count() == 0


def test_rerun_replaces_everything(spark, lazy, tmp_path):
    root = str(tmp_path)
    first = refresh(lazy.raw_trips, lazy.raw_zones, root)
    before = {name: counted(getattr(first, name)) for name in ("daily", "route")}
    rows = first.trips.count()
    again = refresh(lazy.raw_trips.repartition(5), lazy.raw_zones, root, partition_trips_by=())
    assert again.trips.count() == rows
    assert {name: counted(getattr(again, name)) for name in before} == before
    assert counted(StoredLayers.read(spark, root).daily) == before["daily"]


def log(spark, root, name, *columns):
    return sorted(tuple(row) for row in runs.read_log(spark, root, name).select(*columns).collect())


def test_failed_run_leaves_the_old_one(spark, lazy, tmp_path):
    """An error midway is logged, and readers and names stay at the run before."""
    root = str(tmp_path)
    first = refresh(lazy.raw_trips, lazy.raw_zones, root)
    before = counted(first.daily)
    with pytest.raises(Exception, match="rounds to zero"):
        refresh(lazy.raw_trips, lazy.raw_zones, root, TripProfile(strict=True), name="strict")
    assert log(spark, root, runs.RUN_LOG, "run_name", "status") == [
        ("refresh", "STARTED"),
        ("refresh", "SUCCESS"),
        ("strict", "FAILED"),
        ("strict", "STARTED"),
    ]
    failed = runs.read_log(spark, root, runs.LOAD_LOG).where("status = 'FAILED'").collect()
    assert [(row.object_name, row.row_count) for row in failed] == [(layers.TRIPS, 0)]
    assert failed[0].message
    assert counted(StoredLayers.read(spark, root).daily) == before
    publish(spark, root)
    assert counted(spark.table("gold.daily_trip_summary")) == before
    assert spark.table("audit.pipeline_run").count() == 4
    refresh(lazy.raw_trips.limit(0), lazy.raw_zones, root)
    empty = StoredLayers.read(spark, root)
    assert (empty.trips.count(), empty.daily.count()) == (0, 0)
    publish(spark, root)
    assert spark.table("gold.vw_trip_enriched").count() == 0
    assert len(set(log(spark, root, runs.LOAD_LOG, "run_id"))) == 3


def test_lost_trips_fail_the_run(spark, lazy, tmp_path, monkeypatch):
    whole = silver.rejected_trips
    monkeypatch.setattr(silver, "rejected_trips", lambda *a: whole(*a).where("error_type <> 'negative_fare'"))
    with pytest.raises(LostRowsError, match="do not add up"):
        refresh(lazy.raw_trips, lazy.raw_zones, str(tmp_path))
    with pytest.raises(LookupError):
        StoredLayers.read(spark, str(tmp_path))


def test_bad_status_in_a_log_is_found(spark, lazy, tmp_path):
    root = str(tmp_path)
    run = runs.Run.start(spark, root, "x")
    run.log_loads(audit.load_audit({"bronze.a": spark.range(3)}))
    run.log_loads(audit.load_audit({"bronze.a": spark.range(3)}).withColumn("status", F.lit("DONE")))
    run._log("HALF")
    assert {tuple(row) for row in checks.status_values(spark, root).collect()} == {
        (runs.LOAD_LOG, 2, 1),
        (runs.RUN_LOG, 2, 1),
    }


def test_partitions_do_not_change_results(spark, lazy, sf_dir):
    """One or many shuffle partitions, rows in any order: equal to the last digit."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            mixed = layers.Layers(
                lazy.raw_trips.repartition(int(partitions) + 2), lazy.raw_zones.repartition(3)
            )
            results.append([counted(mixed.trips), counted(mixed.payment), counted(mixed.route)])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_large_zone_list(lazy, sf_dir, spark):
    """A zone list too large to broadcast gives the same layers through merge joins."""
    large = standin.layers(spark, sf_dir)
    large.__dict__["zone_size"] = LookupSize(25, 1000, max_rows=1)
    assert counted(large.trips) == counted(lazy.trips)
    assert counted(large.issues) == counted(lazy.issues)
    assert counted(large.route) == counted(lazy.route)
    assert counted(questions.long_trips(large)) == counted(questions.long_trips(lazy))


def test_order_of_reports(lazy):
    days = [row.pickup_date for row in questions.running_revenue(lazy).collect()]
    assert days == sorted(days)
    parts = [row.total_trips for row in questions.day_parts(lazy).collect()]
    assert parts == sorted(parts, reverse=True)
    ranks = [(row.borough, row.borough_rank) for row in questions.top_zones_by_revenue(lazy).collect()]
    assert ranks == sorted(ranks)
    shares = [row.total_trips for row in questions.unusual_hours(lazy).collect()]
    assert shares == sorted(shares, reverse=True)


def test_questions_without_trips(spark, lazy):
    empty = layers.Layers(lazy.raw_trips.where("false"), lazy.raw_zones)
    assert questions.total_trips(empty).first()[0] == 0
    assert tuple(questions.revenue_summary_text(empty).first()) == (None,) * 4
    assert questions.busiest_zones(empty).count() == 10
    assert questions.unusual_hours(empty).count() == 0
    assert questions.small_boroughs(empty).count() == 0


def test_sql_by_name(spark, built, root):
    publish(spark, root)
    top = spark.sql(
        "SELECT borough, zone, total_revenue FROM gold.zone_performance_summary "
        "ORDER BY total_revenue DESC NULLS LAST, location_id LIMIT 10"
    )
    assert top.collect() == questions.top_revenue_zones(built).collect()
    assert counted(spark.table("gold.vw_zone_performance")) == counted(built.zone_view)
    enriched = built.enriched_view
    assert counted(spark.table("gold.vw_trip_enriched").select(*enriched.columns)) == counted(enriched)
    assert spark.table("audit.load_audit").count() == 9
    publish(spark, root)
    assert spark.table("silver.taxi_trips_cleaned").count() == built.trips.count()


def test_exports(spark, built, tmp_path):
    for _ in range(2):  # the second time replaces the files of the first
        export_reports(exports.named_reports(built), str(tmp_path))
        assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == [
            "daily_summary.csv",
            "data_quality_issues.csv",
            "payment_behavior.csv",
            "top_pickup_zones.csv",
        ]
    for name, header in {
        "daily_summary": "pickup_date,total_trips,total_revenue,avg_revenue,avg_fare,avg_tip,avg_distance,avg_duration_minutes",
        "top_pickup_zones": "borough,zone,total_pickup_trips,total_revenue",
        "payment_behavior": "payment_type,payment_label,total_trips,total_revenue,avg_revenue,avg_tip,avg_tip_ratio",
        "data_quality_issues": "error_type,issue_count",
    }.items():
        assert (tmp_path / f"{name}.csv").read_text().splitlines()[0] == header
    lines = (tmp_path / "daily_summary.csv").read_text().splitlines()
    dates = [line.split(",")[0] for line in lines[1:]]
    assert len(dates) == 31 and dates == sorted(dates)


def test_export_that_fails_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "report.csv")
    write_csv(spark.range(3), path)
    before = (tmp_path / "report.csv").read_text()
    with pytest.raises(Exception, match="no good"):
        write_csv(spark.range(3).select(F.raise_error(F.lit("no good")).cast("int").alias("x")), path)
    assert (tmp_path / "report.csv").read_text() == before == "id\n0\n1\n2\n"
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["report.csv"]
    write_csv(spark.range(0), path)
    assert spark.read.csv(path, schema="id long", header=True).count() == 0
    # A folder of that name, as older versions wrote it, is replaced too.
    spark.range(2).write.csv(str(tmp_path / "old.csv"))
    write_csv(spark.range(1), str(tmp_path / "old.csv"))
    assert (tmp_path / "old.csv").read_text() == "id\n0\n"


def test_date_filter_reads_one_partition(spark, lazy, tmp_path):
    trips = refresh(lazy.raw_trips, lazy.raw_zones, str(tmp_path)).trips
    plan = trips.where("pickup_date = DATE'2026-01-05'").select("total_amount")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in text


def test_stored_tables_use_the_shared_folder(spark, lazy):
    base = spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark).rsplit("/", 1)[0]
    kept = stored(lazy.zones, "zones")
    assert counted(kept) == counted(lazy.zones)
    assert all(base.rstrip("/") in name for name in kept.inputFiles())
    assert shared_folder(spark) != shared_folder(spark)


def test_intermediate_tables_are_deleted_with_their_block(spark, lazy, tmp_path):
    before = stored(lazy.zones, "zones")
    with pytest.raises(KeyError):
        with cleaned(spark):
            inside = stored(lazy.zones, "zones")
            with cleaned(spark):
                nested = stored(lazy.zones, "zones")
            assert inside.count() == before.count()
            with pytest.raises(Exception, match="FILE_NOT_EXIST"):
                nested.collect()
            raise KeyError
    with pytest.raises(Exception, match="FILE_NOT_EXIST"):
        inside.collect()
    assert counted(before) == counted(lazy.zones)


def test_command_line(spark, lazy, tmp_path, capsys):
    lazy.raw_trips.drop("source_file").write.parquet(str(tmp_path / "raw"))
    zones = tmp_path / "zones.csv"
    rows = [f"{row.location_id},{row.borough},{row.zone},{row.service_zone}" for row in lazy.zones.collect()]
    zones.write_text("\n".join(["LocationID,Borough,Zone,service_zone", *rows]) + "\n")
    main(
        ["--trips", str(tmp_path / "raw"), "--zones", str(zones)]
        + ["--root", str(tmp_path / "out"), "--exports", str(tmp_path / "csv")]
    )
    assert "exported" in capsys.readouterr().out
    made = StoredLayers.read(spark, str(tmp_path / "out"))
    assert counted(made.daily) == counted(lazy.daily)
    assert {row.source_file[:5] for row in made.raw_trips.select("source_file").distinct().collect()} == {"part-"}
    assert gold.roll_up(made.time_sums).first().trips == made.trips.count()
