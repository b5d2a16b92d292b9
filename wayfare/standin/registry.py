"""Every operator and report as a query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators import quality
from wayfare.plans import checks, exports, questions, runs, silver
from wayfare.plans.layers import Layers, StoredLayers
from wayfare.plans.refresh import refresh
from wayfare.schemas import RAW_TRIPS, TRIP_RENAMES, ZONE_RENAMES
from wayfare.sources.ingest import read_trips, read_zones
from wayfare.sources.sinks import export_reports, shared_folder, stored
from wayfare.standin import trips as standin

Query = Callable[[SparkSession, str], DataFrame]


def comparable(table: DataFrame) -> DataFrame:
    """Types that both engines have: decimals as doubles, computed doubles to 6 digits."""
    columns = []
    for field in table.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = F.round(value.cast("double"), 6)
        elif isinstance(field.dataType, T.DoubleType):
            value = F.round(value, 6)
        columns.append(value.alias(field.name))
    return table.select(*columns)


#: Hold values of the source as they are, so none is rounded for the comparison.
RAW_VALUES = ("bronze_trips", "silver_issues", "silver_valid_trips")


def _over_layers(name: str, build: Callable[[Layers], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = build(standin.layers(spark, sf_dir))
        return found if name in RAW_VALUES else comparable(found)

    return query


def _over_refresh(build: Callable[[StoredLayers, str], DataFrame], times: int = 1) -> Query:
    """For checks of stored tables: build them all from the given tables, then check."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = shared_folder(spark)
        raw = standin.layers(spark, sf_dir)
        for _ in range(times):
            stored = refresh(raw.raw_trips, raw.raw_zones, root)
        return comparable(build(stored, root))

    return query


# --- files written and read again ---------------------------------------------------


def ingest_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as files of two schemas in source spelling, read with a wildcard.

    Trips of odd vendors have a fee that the others lack, and other integer types.
    """
    folder = shared_folder(spark)
    absent = ("source_file", *standin.ABSENT)
    spelled = standin.raw_trips(spark, sf_dir).drop(*absent).withColumnsRenamed(
        {name: source for source, name in TRIP_RENAMES.items() if name not in absent}
    )
    odd = F.coalesce(F.col("VendorID") % 2 == 1, F.lit(False))
    spelled.where(~odd).write.parquet(f"{folder}/first")
    spelled.where(odd).withColumns(
        {
            "VendorID": F.col("VendorID").cast("long"),
            "payment_type": F.col("payment_type").cast("int"),
            "cbd_congestion_fee": F.lit(0.75),
        }
    ).write.parquet(f"{folder}/second")
    return _file_kind(read_trips(spark, f"{folder}/*"))


def ingest_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as CSV in source spelling, missing names as a token, blanks kept, read again."""
    folder = shared_folder(spark)
    standin.raw_zones(spark, sf_dir).drop("source_file").withColumnsRenamed(
        {name: source for source, name in ZONE_RENAMES.items()}
    ).write.csv(
        folder,
        header=True,
        nullValue="N/A",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return _file_kind(read_zones(spark, folder))


def _file_kind(table: DataFrame) -> DataFrame:
    """Spark chooses the names of the files it writes: only their ending is known."""
    return table.withColumn("source_file", F.regexp_extract("source_file", r"\.[a-z]+$", 0))


def _exported(name: str) -> Query:
    """A report written as CSV, and read from that file."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = exports.REPORTS[name](standin.layers(spark, sf_dir))
        (path,) = export_reports({name: report}, shared_folder(spark))
        return comparable(spark.read.csv(path, schema=report[0].schema, header=True))

    return query


def _long_trips(layers: Layers) -> DataFrame:
    # The cleaned trips are read twice (means, then trips): store them once.
    if not isinstance(layers, StoredLayers):
        layers.__dict__["trips"] = stored(layers.trips, "trips")
    return questions.long_trips(layers)


def _valid(layers: Layers) -> DataFrame:
    return silver.valid_trips(layers.raw_trips, layers.zones, layers.zone_size, layers.profile)


_VALID_COLUMNS = (
    "vendor_id",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
)


def _repeated_valid(layers: Layers) -> DataFrame:
    return quality.repeated_keys(
        silver.rounded_trips(_valid(layers)), layers.profile.trip_key, nulls_distinct=True
    )


def _raw_orphans(layers: Layers) -> DataFrame:
    """Ids that are not in the zone list, for both ends of the trips."""
    ends = F.array(
        *[
            F.struct(F.lit(name).alias("trip_end"), F.col(name).alias("location_id"))
            for name in ("pu_location_id", "do_location_id")
        ]
    )
    both = layers.raw_trips.select(F.inline(ends))
    lost = quality.orphans(both, "location_id", layers.zones, "location_id", layers.zone_size)
    return lost.groupBy("trip_end", "location_id").agg(F.count(F.lit(1)).alias("orphans"))


def _raw_ranges(layers: Layers) -> DataFrame:
    allowed = {
        "duration": F.col("tpep_dropoff_datetime") > F.col("tpep_pickup_datetime"),
        "passenger_count": F.col("passenger_count") > 0,
        "trip_distance": F.col("trip_distance") > 0,
        **{name: F.col(name) >= 0 for name in ("fare_amount", "tip_amount", "total_amount")},
    }
    return quality.range_violations(layers.raw_trips, allowed)


_RAW_COLUMNS = [name for name in RAW_TRIPS.names if name != "source_file"]


LAZY: dict[str, Callable[[Layers], DataFrame]] = {
    "bronze_trips": lambda x: x.raw_trips,
    "bronze_zones": lambda x: x.raw_zones,
    "silver_zones": lambda x: x.zones,
    "silver_issues": lambda x: x.issues,
    "silver_valid_trips": lambda x: _valid(x).select(*_VALID_COLUMNS),
    "silver_trips": lambda x: x.trips,
    "gold_daily": lambda x: x.daily,
    "gold_hourly": lambda x: x.hourly,
    "gold_zone": lambda x: x.zone,
    "gold_payment": lambda x: x.payment,
    "gold_route": lambda x: x.route,
    "vw_trip_enriched": lambda x: x.enriched_view,
    "vw_daily": lambda x: x.daily_view,
    "vw_zone_performance": lambda x: x.zone_view,
    "q01_total_trips": questions.total_trips,
    "q02_revenue_text": questions.revenue_summary_text,
    "q02_revenue_raw": questions.revenue_summary,
    "q03_peak_hours": questions.peak_hours,
    "q04_weekday_weekend": questions.day_types,
    "q05_payment": questions.payment_methods,
    "q06_top_zones_trips": questions.busiest_zones,
    "q07_top_zones_revenue": questions.top_revenue_zones,
    "q07_top_zones_text": questions.top_revenue_zones_text,
    "q08_top_routes": questions.busiest_routes,
    "q09_time_period": questions.day_parts,
    "q10_issue_counts": questions.issue_counts,
    "q11_hourly_anomalies": questions.unusual_hours,
    "q13_top_zone_revenue_cte": questions.top_revenue_zones,
    "q14_busy_low_tip": questions.busy_low_tip_zones,
    "q15_daily_vs_avg": questions.daily_versus_mean,
    "q16_long_trips": _long_trips,
    "q17_small_boroughs": questions.small_boroughs,
    "q18_zone_rank": questions.zone_ranking,
    "q19_top3_revenue": questions.top_zones_by_revenue,
    "q20_running_revenue": questions.running_revenue,
    "q21_moving_avg_7": questions.moving_mean_trips,
    "q22_day_delta": questions.revenue_change,
    "q23_top3_trips": questions.top_zones_by_trips,
    "q23_top3_trips_rank": lambda x: questions.top_zones_by_trips(x, method="rank"),
    "q23_top3_trips_dense_rank": lambda x: questions.top_zones_by_trips(x, method="dense_rank"),
    "row_conservation": checks.row_conservation,
    "k1_repeated_raw_zone_ids": lambda x: quality.repeated_keys(x.raw_zones, ["location_id"]),
    "k2_foreign_keys": checks.foreign_keys,
    "k2_raw_orphans": _raw_orphans,
    "k3_not_null": checks.required_values,
    "k3_raw_nulls": lambda x: quality.null_counts(x.raw_trips, _RAW_COLUMNS),
    "k4_ranges": checks.trip_ranges,
    "k4_raw_ranges": _raw_ranges,
    "k5_natural_key": lambda x: checks.natural_key(x).agg(
        F.count(F.lit(1)).alias("repeated_keys")
    ),
    "k5_repeated_valid_trips": _repeated_valid,
}



def _logged(stored: StoredLayers, root: str) -> DataFrame:
    """Logged row counts, and in how many runs each was found."""
    log = runs.read_log(stored.raw_trips.sparkSession, root, runs.LOAD_LOG)
    return log.groupBy("layer_name", "object_name", "row_count", "status").agg(
        F.count_distinct("run_id").alias("runs")
    )


REFRESHED: dict[str, Query] = {
    "load_audit": _over_refresh(_logged, times=2),
    "k1_primary_keys": _over_refresh(lambda stored, _: checks.primary_keys(stored)),
    "k6_status_values": _over_refresh(
        lambda stored, root: checks.status_values(stored.raw_trips.sparkSession, root)
    ),
}

FILES: dict[str, Query] = {
    "ingest_trips": ingest_trips,
    "ingest_zones": ingest_zones,
    **{f"export_{name}": _exported(name) for name in exports.REPORTS},
}


def queries() -> dict[str, Query]:
    return {
        **{name: _over_layers(name, build) for name, build in LAZY.items()},
        **REFRESHED,
        **FILES,
    }
