"""The business questions, each a DataFrame over the layers.

Ties are broken by the key of the mart (or of the trip), so a top-k is always the same.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.numeric import exact_mean, money_text
from wayfare.operators import reports
from wayfare.plans import gold
from wayfare.plans.layers import Layers


def total_trips(layers: Layers) -> DataFrame:
    """Q1: number of cleaned trips."""
    return gold.overall_sums(layers.time_sums).select(
        F.col("trips").alias("jumlah_total_trip_valid")
    )


def _overall(layers: Layers) -> tuple[DataFrame, dict[str, Column]]:
    trips = F.col("trips")
    means = {
        f"avg_{name}": exact_mean(gold.total(total), trips)
        for name, total in (("revenue", "sum_total"), ("fare", "sum_fare"), ("tip", "sum_tip"))
    }
    revenue = gold.total("sum_total")
    some = gold.overall_sums(layers.time_sums).withColumn("trips", F.nullif(trips, F.lit(0)))
    return some, {"total_revenue": revenue, **means}


def revenue_summary(layers: Layers) -> DataFrame:
    """Q2: revenue and mean revenue, fare and tip of all trips, as numbers."""
    sums, values = _overall(layers)
    return sums.select(*[value.alias(name) for name, value in values.items()])


def revenue_summary_text(layers: Layers) -> DataFrame:
    """Q2: the same as money text."""
    sums, values = _overall(layers)
    return sums.select(*[money_text(value).alias(name) for name, value in values.items()])


def peak_hours(layers: Layers, k: int = 10) -> DataFrame:
    """Q3: hours with the most trips."""
    hours = layers.hourly.select("pickup_date", "pickup_hour", "total_trips")
    return reports.top_k(hours, k, ["total_trips"], ["pickup_date", "pickup_hour"])


def day_types(layers: Layers) -> DataFrame:
    """Q4: weekdays against weekends."""
    return gold.day_type_sums(layers.time_sums).orderBy(
        *reports.descending("total_trips"), *reports.ascending("day_type")
    )


def payment_methods(layers: Layers) -> DataFrame:
    """Q5: payment methods by use."""
    ordered = layers.payment.orderBy(
        *reports.descending("total_trips"), *reports.ascending("payment_type")
    )
    return ordered.select("payment_label", "total_trips", "total_revenue")


def busiest_zones(layers: Layers, k: int = 10) -> DataFrame:
    """Q6: zones with the most pickups."""
    top = reports.top_k(layers.zone, k, ["total_pickup_trips"], ["location_id"])
    return top.select("borough", "zone", "total_pickup_trips")


def top_revenue_zones(layers: Layers, k: int = 10) -> DataFrame:
    """Q7 and Q13: zones with the highest revenue."""
    top = reports.top_k(layers.zone, k, ["total_revenue"], ["location_id"])
    return top.select("borough", "zone", "total_revenue")


def top_revenue_zones_text(layers: Layers, k: int = 10) -> DataFrame:
    """Q7 with money text."""
    return top_revenue_zones(layers, k).withColumn(
        "total_revenue", money_text(F.col("total_revenue"))
    )


def busiest_routes(layers: Layers, k: int = 10) -> DataFrame:
    """Q8: routes with the most trips."""
    top = reports.top_k(layers.route, k, ["total_trips"], list(gold.ROUTE_KEYS))
    return top.select(
        "pickup_borough", "pickup_zone", "dropoff_borough", "dropoff_zone", "total_trips"
    )


def day_parts(layers: Layers) -> DataFrame:
    """Q9: trips, revenue and mean duration per part of the day."""
    return gold.day_part_sums(layers.time_sums, layers.profile).orderBy(
        *reports.descending("total_trips"), *reports.ascending("time_period")
    )


def issue_counts(layers: Layers) -> DataFrame:
    """Q10: rejected trips per reason."""
    return (
        layers.issues.groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("issue_count"))
        .orderBy(*reports.descending("issue_count"), *reports.ascending("error_type"))
    )


def unusual_hours(layers: Layers, deviations: float = 2.0) -> DataFrame:
    """Q11: hours whose number of trips is far from the mean of all hours."""
    hours = layers.hourly.select("pickup_date", "pickup_hour", "total_trips")
    return reports.outliers(hours, "total_trips", deviations).orderBy(
        *reports.descending("total_trips"), *reports.ascending("pickup_date", "pickup_hour")
    )


def busy_low_tip_zones(layers: Layers, busy: float = 0.75, low: float = 0.25) -> DataFrame:
    """Q14: zones in the upper part by pickups and in the lower part by mean tip."""
    served = layers.zone.where(F.col("total_pickup_trips") > 0)
    ranked = reports.percentiles_of(
        served, {"pickup_percentile": "total_pickup_trips", "tip_percentile": "avg_tip"}
    )
    chosen = ranked.where((F.col("pickup_percentile") >= busy) & (F.col("tip_percentile") <= low))
    return chosen.orderBy(
        *reports.descending("total_pickup_trips"), *reports.ascending("location_id")
    ).select(
        "borough", "zone", "total_pickup_trips", "avg_tip", "pickup_percentile", "tip_percentile"
    )


def daily_versus_mean(layers: Layers) -> DataFrame:
    """Q15: revenue of each day beside the mean of the days."""
    days = layers.daily.select("pickup_date", "total_revenue")
    compared = reports.versus_mean(days, "total_revenue", "avg_daily_revenue", "revenue_vs_average")
    return compared.orderBy("pickup_date")


def long_trips(layers: Layers, k: int = 100) -> DataFrame:
    """Q16: longest trips among those longer than the mean of their pickup zone.

    Zone names are joined to the chosen trips only. The natural key settles ties.
    """
    trips = layers.trips
    shown = [column for column in ("trip_id", "pickup_datetime") if column in trips.columns]
    keys = dict.fromkeys([*shown, *layers.profile.trip_key])
    trips = trips.select(*keys, "trip_duration_minutes")
    longer = reports.above_group_mean(
        trips, "pickup_location_id", "trip_duration_minutes", "avg_zone_duration", layers.zone_size
    )
    top = reports.top_k(longer, k, ["trip_duration_minutes"], layers.profile.trip_key)
    names = gold.zone_names(layers.zones, "pickup", "borough", "zone")
    return (
        top.join(names, "pickup_location_id")
        .orderBy(
            *reports.descending("trip_duration_minutes"),
            *reports.ascending(*layers.profile.trip_key),
        )
        .select(
            *shown,
            "pickup_borough",
            "pickup_zone",
            "trip_duration_minutes",
            "avg_zone_duration",
        )
    )


def small_boroughs(layers: Layers, below: Decimal = Decimal("0.05")) -> DataFrame:
    """Q17: pickup boroughs with a small share of the revenue."""
    boroughs = gold.borough_sums(layers.route_sums, layers.zones)
    shares = reports.share_of_total(boroughs, "total_revenue", "revenue_share")
    return reports.below_share(shares, "total_revenue", below).orderBy(
        *reports.ascending("revenue_share", "pickup_borough")
    )


def zone_ranking(layers: Layers) -> DataFrame:
    """Q18: all zones ranked by revenue."""
    zones = layers.zone.select("borough", "zone", "total_revenue")
    return reports.rank_all(zones, "total_revenue", "revenue_rank")


def top_zones_by_revenue(layers: Layers, k: int = 3) -> DataFrame:
    """Q19: best zones of each borough by revenue."""
    ranked = reports.top_k_per_group(
        layers.zone, k, "borough", ["total_revenue"], ["location_id"], rank="borough_rank"
    )
    return ranked.orderBy("borough", "borough_rank").select(
        "borough", "zone", "total_revenue", "total_pickup_trips", "borough_rank"
    )


def running_revenue(layers: Layers) -> DataFrame:
    """Q20: revenue up to and including each day."""
    days = layers.daily.select("pickup_date", "total_revenue")
    return reports.running_total(
        days, "pickup_date", "total_revenue", "running_total_revenue"
    ).orderBy("pickup_date")


def moving_mean_trips(layers: Layers, rows: int = 7) -> DataFrame:
    """Q21: mean number of trips over the last seven rows."""
    days = layers.daily.select("pickup_date", "total_trips")
    return reports.moving_mean(
        days, "pickup_date", "total_trips", "moving_avg_trip_7d", rows
    ).orderBy("pickup_date")


def revenue_change(layers: Layers) -> DataFrame:
    """Q22: revenue of the day before, and the difference."""
    days = layers.daily.select("pickup_date", "total_revenue")
    return reports.change_from_previous(
        days, "pickup_date", "total_revenue", "previous_day_revenue", "revenue_delta"
    ).orderBy("pickup_date")


def top_zones_by_trips(layers: Layers, k: int = 3, method: str = "row_number") -> DataFrame:
    """Q23: best zones of each borough by trips, then revenue.

    ``method`` may be ``row_number``, ``rank`` or ``dense_rank``; only the first needs
    the zone id to settle ties.
    """
    served = layers.zone.where(F.col("total_pickup_trips") > 0)
    ranked = reports.top_k_per_group(
        served,
        k,
        "borough",
        ["total_pickup_trips", "total_revenue"],
        ["location_id"] if method == "row_number" else [],
        method,
        "zone_rank",
    )
    return ranked.orderBy("borough", "zone_rank").select(
        "borough", "zone", "total_pickup_trips", "total_revenue", "zone_rank"
    )
