"""The layers of one load, derived on the fly or read from a finished refresh."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators.lookup import LookupSize, measure_lookup
from wayfare.plans import gold, silver, views
from wayfare.plans.runs import latest_run, leased, run_folder, table_path
from wayfare.profile import DEFAULT_PROFILE, TripProfile
from wayfare.schemas import STORED_TRIPS

# Names of the stored tables.
RAW_TRIPS = "bronze.raw_taxi_trips"
RAW_ZONES = "bronze.raw_taxi_zones"
ZONES = "silver.taxi_zones"
TRIPS = "silver.taxi_trips_cleaned"
ISSUES = "silver.data_quality_issues"
DAILY = "gold.daily_trip_summary"
HOURLY = "gold.hourly_demand_summary"
ZONE = "gold.zone_performance_summary"
PAYMENT = "gold.payment_behavior_summary"
ROUTE = "gold.route_performance_summary"
ENRICHED_VIEW = "gold.vw_trip_enriched"
DAILY_VIEW = "gold.vw_daily_trip_summary"
ZONE_VIEW = "gold.vw_zone_performance"

# Sums behind the marts, kept so that questions on all trips need not scan them.
TIME_SUMS = "gold.time_sums"
ROUTE_SUMS = "gold.route_sums"

AUDITED = (RAW_ZONES, RAW_TRIPS, TRIPS, ISSUES, DAILY, HOURLY, ZONE, PAYMENT, ROUTE)


@dataclass(frozen=True)
class Layers:
    """Raw tables, and all that follows from them. Nothing runs until a result is used,
    except for the count of the zone list and the range of payment codes that plans rely on."""

    raw_trips: DataFrame
    raw_zones: DataFrame
    profile: TripProfile = DEFAULT_PROFILE

    @cached_property
    def zones(self) -> DataFrame:
        return silver.clean_zones(self.raw_zones, self.profile)

    @cached_property
    def zone_size(self) -> LookupSize:
        return measure_lookup(self.zones, "location_id")

    @cached_property
    def classified(self) -> DataFrame:
        return silver.classify(self.raw_trips, self.zones, self.zone_size, self.profile)

    @cached_property
    def issues(self) -> DataFrame:
        return silver.rejected_trips(self.classified, self.profile)

    @cached_property
    def codes_fit(self) -> bool:
        """Whether all payment codes fit the packed form in which duplicates are compared.

        One row comes back to the driver; a single column is read. A refresh does without, as it
        sees the codes while it stores the classified trips.
        """
        bounds = self.raw_trips.agg(
            F.min("payment_type").alias("least"), F.max("payment_type").alias("largest")
        )
        return bounds.select(silver.codes_fit(F.col("least"), F.col("largest"))).first()[0]

    @cached_property
    def trips(self) -> DataFrame:
        return silver.cleaned_trips(
            self.raw_trips, self.zones, self.zone_size, self.profile, self.codes_fit
        )

    @cached_property
    def time_sums(self) -> DataFrame:
        return gold.unit_sums(self.trips)

    @cached_property
    def route_sums(self) -> DataFrame:
        return gold.unit_sums(self.trips)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.daily_mart(self.time_sums)

    @cached_property
    def hourly(self) -> DataFrame:
        return gold.hourly_mart(self.time_sums, self.profile)

    @cached_property
    def payment(self) -> DataFrame:
        return gold.payment_mart(self.time_sums, self.profile)

    @cached_property
    def zone(self) -> DataFrame:
        return gold.zone_mart(self.route_sums, self.zones)

    @cached_property
    def route(self) -> DataFrame:
        return gold.route_mart(self.route_sums, self.zones, self.zone_size)

    @cached_property
    def enriched_view(self) -> DataFrame:
        return views.enriched_trips(self.trips, self.zones, self.zone_size)

    @cached_property
    def daily_view(self) -> DataFrame:
        return views.daily_view(self.daily)

    @cached_property
    def zone_view(self) -> DataFrame:
        return views.zone_view(self.zone, self.route_sums)


# Stored table of each layer attribute.
STORED = {
    "raw_trips": RAW_TRIPS,
    "raw_zones": RAW_ZONES,
    "zones": ZONES,
    "trips": TRIPS,
    "issues": ISSUES,
    "time_sums": TIME_SUMS,
    "route_sums": ROUTE_SUMS,
    "daily": DAILY,
    "hourly": HOURLY,
    "zone": ZONE,
    "payment": PAYMENT,
    "route": ROUTE,
}


class StoredLayers(Layers):
    """The same layers, each read from its stored table."""

    def __init__(self, tables: Mapping[str, DataFrame], profile: TripProfile = DEFAULT_PROFILE):
        """``tables`` by table name."""
        for attribute, name in STORED.items():
            self.__dict__[attribute] = tables[name]
        self.__dict__["profile"] = profile

    @classmethod
    def read(
        cls, spark: SparkSession, root: str, profile: TripProfile = DEFAULT_PROFILE
    ) -> StoredLayers:
        """The layers of the last refresh below ``root`` that succeeded.

        ``retain`` may delete them when newer ones have come; ``StoredLayers.leased`` holds them.
        """
        return cls._of_run(spark, root, latest_run(spark, root), profile)

    @classmethod
    @contextmanager
    def leased(
        cls, spark: SparkSession, root: str, profile: TripProfile = DEFAULT_PROFILE
    ) -> Iterator[StoredLayers]:
        """``read`` for a ``with`` block, in which the tables are not deleted."""
        with leased(spark, root) as run_id:
            yield cls._of_run(spark, root, run_id, profile)

    @classmethod
    def _of_run(
        cls, spark: SparkSession, root: str, run_id: str, profile: TripProfile
    ) -> StoredLayers:
        folder = run_folder(root, run_id)
        tables = {}
        for name in STORED.values():
            reader = spark.read.schema(STORED_TRIPS) if name == TRIPS else spark.read
            tables[name] = reader.parquet(table_path(folder, name))
        return cls(tables, profile)
