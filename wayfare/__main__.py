"""Rebuild all layers from raw files and export the named reports.

    python -m wayfare
        --trips '/data/raw/*.parquet' --zones /data/raw/zones.csv --root /data/layers --exports /data/out
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from wayfare.plans.exports import named_reports
from wayfare.plans.refresh import publish, refresh
from wayfare.plans.runs import retain
from wayfare.profile import DEFAULT_PROFILE, TripProfile
from wayfare.session import apply_settings
from wayfare.sources.ingest import read_trips, read_zones
from wayfare.sources.sinks import export_reports


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wayfare", description=__doc__)
    parser.add_argument("--trips", nargs="+", required=True, help="trip files (Parquet)")
    parser.add_argument("--zones", required=True, help="zone list (CSV with header)")
    parser.add_argument("--root", required=True, help="folder of the stored layers")
    parser.add_argument("--exports", help="folder for the exported reports")
    parser.add_argument("--start", type=datetime.fromisoformat, default=DEFAULT_PROFILE.window_start)
    parser.add_argument("--end", type=datetime.fromisoformat, default=DEFAULT_PROFILE.window_end)
    parser.add_argument("--window-error", default=DEFAULT_PROFILE.window_error)
    parser.add_argument("--strict", action="store_true", help="fail when a value rounds to zero")
    parser.add_argument("--keep", type=int, help="delete all but so many successful runs")
    options = parser.parse_args(argv)

    spark = SparkSession.builder.appName("wayfare").getOrCreate()
    apply_settings(spark)
    profile = TripProfile(
        window_start=options.start,
        window_end=options.end,
        window_error=options.window_error,
        strict=options.strict,
    )
    layers = refresh(
        read_trips(spark, options.trips), read_zones(spark, options.zones), options.root, profile
    )
    publish(spark, options.root)
    if options.keep:
        for run_id in retain(spark, options.root, options.keep):
            print(f"deleted run {run_id}")
    if options.exports:
        for path in export_reports(named_reports(layers), options.exports):
            print(f"exported {path}")
    spark.sql("SELECT layer_name, object_name, row_count, status FROM audit.load_audit").show(
        truncate=False
    )


if __name__ == "__main__":
    main()
