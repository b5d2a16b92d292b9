"""Rebuild all stored tables, and make them known by name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import audit
from wayfare.operators.lookup import measure_lookup
from wayfare.plans import gold, layers, silver, views
from wayfare.plans.layers import Layers, StoredLayers
from wayfare.plans.runs import LOAD_LOG, RUN_LOG, Run, latest_run, run_folder, table_path
from wayfare.profile import DEFAULT_PROFILE, TripProfile
from wayfare.schemas import CLEANED_TRIPS, STORED_TRIPS
from wayfare.sources.ingest import stamped
from wayfare.sources.sinks import rebalanced, remove, write_counted


def refresh(
    raw_trips: DataFrame,
    raw_zones: DataFrame,
    root: str,
    profile: TripProfile = DEFAULT_PROFILE,
    partition_trips_by: tuple[str, ...] = ("pickup_date",),
    name: str = "refresh",
) -> StoredLayers:
    """Build every stored table in a new run folder below ``root``.

    The run counts when all tables are written and every raw trip is accounted for; then
    ``StoredLayers.read`` and ``publish`` find it. If anything fails, the error is logged
    and raised, and the run before stays the current one. Running it again gives the same
    tables but for the surrogate ids and the load stamps. Folders of old runs stay until
    ``runs.retain`` deletes them.

    Each layer is read back before the next is derived, so a lost executor costs a reread
    of files and never a recomputation of the whole chain. ``partition_trips_by`` stores
    the cleaned trips by date, which lets date filters skip files; ``()`` saves the
    shuffle that this takes.
    """
    run = Run.start(raw_trips.sparkSession, root, name)
    made: dict[str, DataFrame] = {}
    seen: dict[str, dict[str, int]] = {}
    current = [layers.RAW_TRIPS]
    try:
        _build(raw_trips, raw_zones, run, profile, partition_trips_by, made, seen, current)
        current.append("audit.row_conservation")
        balance = audit.balance(
            raw_rows=seen[layers.RAW_TRIPS]["rows"],
            kept_rows=seen[layers.TRIPS]["rows"],
            rejected_rows=seen[layers.ISSUES]["rows"],
            folded_rows=seen[layers.TRIPS]["copies"] or 0,
        )
        if balance["status"] != "SUCCESS":
            raise LostRowsError(f"trips do not add up: {balance}")
        current.append(LOAD_LOG)
        counts = {object_name: seen[object_name]["rows"] for object_name in layers.AUDITED}
        run.log_loads(audit.logged(run.spark, counts))
    except Exception as error:
        run.fail(current[-1], error)
        raise
    run.succeed()
    return StoredLayers(made, profile)


class LostRowsError(RuntimeError):
    """Raw trips are not all cleaned, rejected or dropped as duplicates."""


class NoRoomError(ValueError):
    """A strict load met values that the cleaned columns cannot hold."""


def _build(
    raw_trips: DataFrame,
    raw_zones: DataFrame,
    run: Run,
    profile: TripProfile,
    partition_trips_by: tuple[str, ...],
    made: dict[str, DataFrame],
    seen: dict[str, dict[str, int]],
    current: list[str],
) -> None:
    """Write all tables; ``made`` gets them by name, ``seen`` what was counted while they were
    written, ``current`` the names as they begin."""

    def put(table: DataFrame, name: str, partition_by: tuple[str, ...] = (), **watched) -> DataFrame:
        current.append(name)
        path = table_path(run.folder, name)
        made[name], seen[name] = write_counted(table, path, partition_by, **watched)
        return made[name]

    bronze = put(stamped(raw_trips), layers.RAW_TRIPS)
    raw = Layers(bronze, put(stamped(raw_zones), layers.RAW_ZONES), profile)
    zones = put(raw.zones, layers.ZONES)
    size = measure_lookup(zones, "location_id")

    # The only reader of the raw trips: each is classified once and stored by its route.
    current.append(layers.ISSUES)
    routed = f"{run.folder}/routed"
    code = F.col("payment_type")
    classified, found = write_counted(
        silver.with_route(silver.classify(bronze, zones, size, profile)),
        routed,
        (silver.ROUTE,),
        metrics={
            "fit": silver.codes_fit(F.min(code), F.max(code)),
            "no_room": F.count_if(silver.lacks_room()),
            **silver.payload_metrics(),
        },
    )

    def route(name: str) -> DataFrame:
        return classified.where(F.col(silver.ROUTE) == name).drop(silver.ROUTE)

    rejected = silver.rejected_trips(route(silver.REJECTED), profile)
    put(stamped(silver.with_row_id(rejected, "issue_id"), "logged_at"), layers.ISSUES)

    current.append(layers.TRIPS)
    if profile.strict and found["no_room"]:
        raise NoRoomError(f"{silver.NO_ROOM}: {found['no_room']} trips")
    unique = silver.unique_of_routes(
        route(silver.KEYED),
        route(silver.SINGLE),
        profile,
        packed=found["fit"] is not False,
        copies=silver.COPIES,
        narrow=silver.narrow_packing(found),
    )
    if partition_trips_by:
        # Before the derived columns are added: this shuffle does not carry them either.
        values = silver.cleaned_columns(partition_trips_by, profile)
        unique = unique.withColumns(dict(zip(partition_trips_by, values)))
        unique = rebalanced(unique, *partition_trips_by)
    cleaned = unique.select(
        silver.COPIES, *silver.cleaned_columns(CLEANED_TRIPS.names, profile)
    )
    trips = put(
        stamped(silver.with_row_id(cleaned, "trip_id")),
        layers.TRIPS,
        partition_trips_by,
        metrics={"copies": F.sum(silver.COPIES)},
        drop=(silver.COPIES,),
    )
    remove(run.spark, routed)

    by_time = put(gold.time_sums(trips), layers.TIME_SUMS)
    by_route = put(gold.route_sums(trips), layers.ROUTE_SUMS)
    put(gold.daily_mart(by_time), layers.DAILY)
    put(gold.hourly_mart(by_time, profile), layers.HOURLY)
    put(gold.payment_mart(by_time, profile), layers.PAYMENT)
    put(gold.zone_mart(by_route, zones), layers.ZONE)
    put(gold.route_mart(by_route, zones, size), layers.ROUTE)


_VIEWS = {
    layers.ENRICHED_VIEW: views.enriched_sql().format(
        trips=layers.TRIPS, pickups=layers.ZONES, dropoffs=layers.ZONES
    ),
    layers.DAILY_VIEW: views.DAILY_SQL.format(daily=layers.DAILY),
    layers.ZONE_VIEW: views.ZONE_SQL.format(zones=layers.ZONE, sums=layers.ROUTE_SUMS),
}


def publish(spark: SparkSession, root: str) -> None:
    """Name the stored tables and views in the catalog, for questions asked in SQL.

    ``spark.sql("SELECT * FROM gold.daily_trip_summary")`` then works as is, on the tables
    of the last run that succeeded. Spark joins the zone list by its file size: broadcast
    while it is small, shuffled beyond.
    """
    folder = run_folder(root, latest_run(spark, root))
    places = {name: folder for name in layers.STORED.values()}
    for name, place in {**places, LOAD_LOG: root, RUN_LOG: root}.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        try:  # schema and partition columns come from the files
            spark.catalog.createTable(name, path=table_path(place, name), source="parquet")
        except AnalysisException as error:
            if name != layers.TRIPS or "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            # No valid trip, so no file.
            spark.catalog.createTable(
                name, path=table_path(place, name), source="parquet", schema=STORED_TRIPS
            )
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
    for name, text in _VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
