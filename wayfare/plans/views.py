"""Views over the cleaned trips and the marts.

Each is defined once, as a query with places for its tables. The DataFrame functions put
tables in these places, and ``publish`` the names of stored ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wayfare.operators.lookup import LookupSize, lookup_hint

_TRIP_COLUMNS = (
    "trip_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_date",
    "pickup_hour",
    "pickup_day_name",
    "is_weekend",
    "time_period",
    "trip_duration_minutes",
    "passenger_count",
    "trip_distance",
    "payment_type",
    "payment_label",
    "fare_amount",
    "tip_amount",
    "total_amount",
)
_ZONE_COLUMNS = ("location_id", "borough", "zone", "service_zone")
_ENDS = ("pickup", "dropoff")


def enriched_sql(columns: Sequence[str] = _TRIP_COLUMNS) -> str:
    """Trips with the names of both zones, in ``{trips}``, ``{pickups}`` and ``{dropoffs}`` (the
    zones twice)."""
    shown = [f"trip.{column}" for column in columns if column in _TRIP_COLUMNS]
    for end in _ENDS:
        shown += [f"{end}.{column} AS {end}_{column}" for column in _ZONE_COLUMNS]
    joins = [f"JOIN {{{end}s}} AS {end} ON {end}.location_id = trip.{end}_location_id" for end in _ENDS]
    return f"SELECT {', '.join(shown)} FROM {{trips}} AS trip {' '.join(joins)}"


DAILY_SQL = "SELECT * FROM {daily}"

# The dropoffs are added up per zone before they meet the zone mart, ``{zones}``.
ZONE_SQL = """
    WITH ends AS (
        SELECT dropoff_location_id AS location_id, sum(trips) AS dropoffs FROM {sums} GROUP BY 1)
    SELECT location_id, borough, zone, total_pickup_trips,
           coalesce(dropoffs, 0) AS total_dropoff_trips,
           total_revenue, avg_fare, avg_tip, avg_distance
    FROM {zones} LEFT JOIN ends USING (location_id)"""


def enriched_trips(trips: DataFrame, zones: DataFrame, size: LookupSize) -> DataFrame:
    """Every cleaned trip with the names of both its zones."""
    zones = lookup_hint(zones, size)
    query = enriched_sql(trips.columns)
    return trips.sparkSession.sql(query, trips=trips, pickups=zones, dropoffs=zones)


def daily_view(daily: DataFrame) -> DataFrame:
    return daily.sparkSession.sql(DAILY_SQL, daily=daily)


def zone_view(zone: DataFrame, sums: DataFrame) -> DataFrame:
    """The zone mart with the number of trips that end in each zone."""
    return zone.sparkSession.sql(ZONE_SQL, zones=zone, sums=sums)
