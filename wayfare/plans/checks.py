"""Constraint checks and row counts of the layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import audit, quality
from wayfare.plans import layers as names
from wayfare.plans import runs, silver
from wayfare.plans.layers import Layers, StoredLayers
from wayfare.schemas import CLEANED_TRIPS

# Primary keys, required columns and allowed ranges of the stored tables.
PRIMARY_KEYS = {
    names.ZONES: ("location_id",),
    names.TRIPS: ("trip_id",),
    names.ISSUES: ("issue_id",),
    names.DAILY: ("pickup_date",),
    names.HOURLY: ("pickup_date", "pickup_hour"),
    names.ZONE: ("location_id",),
    names.PAYMENT: ("payment_type",),
    names.ROUTE: ("pickup_location_id", "dropoff_location_id"),
}
REQUIRED_TRIP_COLUMNS = tuple(name for name in CLEANED_TRIPS.names if name != "vendor_id")


def stored_tables(stored: StoredLayers) -> dict[str, DataFrame]:
    return {
        names.RAW_ZONES: stored.raw_zones,
        names.RAW_TRIPS: stored.raw_trips,
        names.ZONES: stored.zones,
        names.TRIPS: stored.trips,
        names.ISSUES: stored.issues,
        names.DAILY: stored.daily,
        names.HOURLY: stored.hourly,
        names.ZONE: stored.zone,
        names.PAYMENT: stored.payment,
        names.ROUTE: stored.route,
    }


def load_audit(stored: StoredLayers) -> DataFrame:
    """Row count of every logged table, after a refresh."""
    tables = stored_tables(stored)
    return audit.load_audit({name: tables[name] for name in names.AUDITED})


def row_conservation(layers: Layers) -> DataFrame:
    """Raw rows = cleaned + rejected + dropped duplicates.

    One scan classifies the raw trips, and one shuffle folds those that pass the filters of the
    cleaned trips, which are written apart from the rules' outcome. Stored tables are counted.
    """
    one = F.count(F.lit(1))
    if isinstance(layers, StoredLayers):
        outcomes = layers.raw_trips.agg(one.alias("raw_rows")).select(
            "raw_rows", layers.issues.agg(one).scalar().alias("rejected_rows")
        )
    else:
        outcomes = layers.classified.agg(
            one.alias("raw_rows"), F.count("error_type").alias("rejected_rows")
        )
    valid = silver.valid_trips(layers.raw_trips, layers.zones, layers.zone_size, layers.profile)
    unique = silver.unique_trips(
        silver.rounded_trips(valid), layers.profile, layers.codes_fit, silver.COPIES
    )
    kept = unique.agg(
        one.alias("kept_rows"),
        (F.coalesce(F.sum(silver.COPIES), F.lit(0)) - one).alias("dropped_rows"),
    )
    if isinstance(layers, StoredLayers):
        kept = kept.select(layers.trips.agg(one).scalar().alias("kept_rows"), "dropped_rows")
    return audit.row_conservation(outcomes, kept)


def primary_keys(stored: StoredLayers) -> DataFrame:
    """Per table, how many different keys it has and how many are repeated or missing."""
    tables = stored_tables(stored)
    counts = [
        quality.key_counts(tables[name], keys).select(F.lit(name).alias("object_name"), "*")
        for name, keys in PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def foreign_keys(layers: Layers) -> DataFrame:
    """Number of trips per end whose zone is not in the zone list."""
    counts = [
        quality.orphans(layers.trips, column, layers.zones, "location_id", layers.zone_size)
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit(column).alias("check_name"), "violations")
        for column in ("pickup_location_id", "dropoff_location_id")
    ]
    return reduce(DataFrame.unionByName, counts)


def required_values(layers: Layers) -> DataFrame:
    return quality.null_counts(layers.trips, REQUIRED_TRIP_COLUMNS)


def trip_ranges(layers: Layers) -> DataFrame:
    positive = ("trip_duration_minutes", "passenger_count", "trip_distance")
    not_negative = ("fare_amount", "tip_amount", "total_amount")
    return quality.range_violations(
        layers.trips,
        {
            "pickup_hour": F.col("pickup_hour").between(0, 23),
            **{name: F.col(name) > 0 for name in positive},
            **{name: F.col(name) >= 0 for name in not_negative},
        },
    )


def natural_key(layers: Layers) -> DataFrame:
    """Natural keys that occur more than once; a NULL vendor repeats nothing."""
    return quality.repeated_keys(layers.trips, layers.profile.trip_key, nulls_distinct=True)


def status_values(spark: SparkSession, root: str) -> DataFrame:
    """Per log below ``root``: its rows, and how many of them have a state that is not allowed."""
    allowed = {
        runs.LOAD_LOG: audit.STATUSES,
        runs.RUN_LOG: (runs.STARTED, *audit.STATUSES),
    }
    counts = []
    for name, states in allowed.items():
        # A missing state is not allowed either.
        bad = F.col("status").isNull() | ~F.col("status").isin(*states)
        counts.append(
            runs.read_log(spark, root, name)
            .agg(F.count(F.lit(1)).alias("log_rows"), F.count(F.when(bad, 1)).alias("violations"))
            .select(F.lit(name).alias("object_name"), "log_rows", "violations")
        )
    return reduce(DataFrame.unionByName, counts)
