"""Marts.

All marts are roll-ups of additive sums. ``unit_sums`` writes each trip as a row of sums
over one trip; ``roll_up`` adds such rows per key. It does not matter to a mart whether
it starts from the trips or from sums that were added up before, since the sums are
exact. A single mart is therefore one aggregation of the trips, and a full refresh
scans the trips twice for all marts together (``time_sums`` and ``route_sums``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.labels import label_of
from wayfare.functions.numeric import cents_high, cents_low, cents_total, mean, ratio_or_zero
from wayfare.functions.temporal import day_part, is_weekend
from wayfare.operators.lookup import LookupSize, lookup_join
from wayfare.profile import DEFAULT_PROFILE, TripProfile

TIME_KEYS = ("pickup_date", "pickup_hour", "payment_type")
ROUTE_KEYS = ("pickup_location_id", "dropoff_location_id")

_SUMMED = {
    "sum_total": "total_amount",
    "sum_fare": "fare_amount",
    "sum_tip": "tip_amount",
    "sum_distance": "trip_distance",
    "sum_minutes": "trip_duration_minutes",
}
_RATIO = "sum_tip_ratio"
_PARTS = {"_high": cents_high, "_low": cents_low}


def total(name: str) -> Column:
    """The exact decimal sum called ``name``, over rows of sums."""
    return cents_total(*[F.col(name + part) for part in _PARTS])


def unit_sums(trips: DataFrame) -> DataFrame:
    """Each trip as sums over one trip, with the key columns of the marts.

    Amounts are two whole numbers each (see ``cents_high``), so their sums have a fixed width and
    need no decimal arithmetic per row; only tip ratios have more digits and stay decimals.
    """
    ratio = ratio_or_zero(F.col("tip_amount"), F.col("total_amount"))
    return trips.select(
        *TIME_KEYS,
        *ROUTE_KEYS,
        F.lit(1).cast("long").alias("trips"),
        *[
            cut(F.col(column)).alias(name + part)
            for name, column in _SUMMED.items()
            for part, cut in _PARTS.items()
        ],
        ratio.alias(_RATIO),
    )


def roll_up(sums: DataFrame, *keys: str | Column) -> DataFrame:
    """Add up sums per key. Spark folds rows before the shuffle, so a key with a third of
    the trips sends one row per task; sums that nobody reads later are not computed."""
    names = [name for name in sums.columns if name == "trips" or name.startswith("sum_")]
    return sums.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def time_sums(trips: DataFrame) -> DataFrame:
    return roll_up(unit_sums(trips), *TIME_KEYS)


def route_sums(trips: DataFrame) -> DataFrame:
    """No mart of routes or zones has tip ratios."""
    return roll_up(unit_sums(trips).drop(_RATIO), *ROUTE_KEYS)


def _revenue() -> Column:
    return total("sum_total").alias("total_revenue")


def _mean(of: str, name: str) -> Column:
    return mean(F.col(of) if of == _RATIO else total(of), F.col("trips")).alias(name)


def _period(profile: TripProfile) -> Column:
    return day_part(F.col("pickup_hour"), profile.day_parts, profile.other_day_part)


# --- marts ------------------------------------------------------------------------


def daily_mart(sums: DataFrame) -> DataFrame:
    """One row per date."""
    return roll_up(sums, "pickup_date").select(
        "pickup_date",
        F.col("trips").alias("total_trips"),
        _revenue(),
        _mean("sum_total", "avg_revenue"),
        _mean("sum_fare", "avg_fare"),
        _mean("sum_tip", "avg_tip"),
        _mean("sum_distance", "avg_distance"),
        _mean("sum_minutes", "avg_duration_minutes"),
    )


def hourly_mart(sums: DataFrame, profile: TripProfile = DEFAULT_PROFILE) -> DataFrame:
    """One row per date and hour."""
    return roll_up(sums, "pickup_date", "pickup_hour").select(
        "pickup_date",
        "pickup_hour",
        _period(profile).alias("time_period"),
        F.col("trips").alias("total_trips"),
        _revenue(),
        _mean("sum_minutes", "avg_duration_minutes"),
    )


def payment_mart(sums: DataFrame, profile: TripProfile = DEFAULT_PROFILE) -> DataFrame:
    """One row per payment code."""
    label = label_of(F.col("payment_type"), profile.payment_labels, profile.other_payment)
    return roll_up(sums, "payment_type").select(
        "payment_type",
        label.alias("payment_label"),
        F.col("trips").alias("total_trips"),
        _revenue(),
        _mean("sum_total", "avg_revenue"),
        _mean("sum_tip", "avg_tip"),
        _mean("sum_tip_ratio", "avg_tip_ratio"),
    )


def zone_mart(sums: DataFrame, zones: DataFrame) -> DataFrame:
    """One row per zone, also those without pickups: count 0, money and means NULL.

    The trips are added up per zone id first; only those few rows meet the zone names.
    """
    per_zone = roll_up(sums, "pickup_location_id").withColumnRenamed(
        "pickup_location_id", "location_id"
    )
    return zones.join(per_zone, "location_id", "left").select(
        "location_id",
        "borough",
        "zone",
        F.coalesce(F.col("trips"), F.lit(0)).alias("total_pickup_trips"),
        _revenue(),
        _mean("sum_fare", "avg_fare"),
        _mean("sum_tip", "avg_tip"),
        _mean("sum_distance", "avg_distance"),
    )


def zone_names(zones: DataFrame, end: str, *columns: str) -> DataFrame:
    """Zone columns named for one end of the trip (``pickup`` or ``dropoff``)."""
    return zones.select(
        F.col("location_id").alias(f"{end}_location_id"),
        *[F.col(column).alias(f"{end}_{column}") for column in columns],
    )


def route_mart(sums: DataFrame, zones: DataFrame, size: LookupSize) -> DataFrame:
    """One row per pair of zones with at least one trip; names are joined to the sums."""
    routes = roll_up(sums, *ROUTE_KEYS)
    for end in ("pickup", "dropoff"):
        names = zone_names(zones, end, "borough", "zone")
        routes = lookup_join(routes, names, f"{end}_location_id", "inner", size)
    return routes.select(
        "pickup_location_id",
        "pickup_borough",
        "pickup_zone",
        "dropoff_location_id",
        "dropoff_borough",
        "dropoff_zone",
        F.col("trips").alias("total_trips"),
        _revenue(),
        _mean("sum_minutes", "avg_duration_minutes"),
        _mean("sum_distance", "avg_distance"),
    )


# --- summaries that the questions ask of the trips as a whole ----------------------


def overall_sums(sums: DataFrame) -> DataFrame:
    """One row for all trips; no trips give a count of 0 and NULL sums."""
    return roll_up(sums).withColumn("trips", F.coalesce(F.col("trips"), F.lit(0)))


def day_type_sums(sums: DataFrame) -> DataFrame:
    day_type = F.when(is_weekend(F.col("pickup_date")), "Weekend").otherwise("Weekday")
    return roll_up(sums, day_type.alias("day_type")).select(
        "day_type", F.col("trips").alias("total_trips"), _revenue()
    )


def day_part_sums(sums: DataFrame, profile: TripProfile = DEFAULT_PROFILE) -> DataFrame:
    return roll_up(sums, _period(profile).alias("time_period")).select(
        "time_period",
        F.col("trips").alias("total_trips"),
        _revenue(),
        _mean("sum_minutes", "avg_duration_minutes"),
    )


def borough_sums(sums: DataFrame, zones: DataFrame) -> DataFrame:
    """Revenue per pickup borough, added up per zone id before the names are joined."""
    per_zone = roll_up(sums, "pickup_location_id")
    named = per_zone.join(zone_names(zones, "pickup", "borough"), "pickup_location_id")
    return roll_up(named, "pickup_borough").select("pickup_borough", _revenue())
