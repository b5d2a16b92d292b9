"""The named reports that are exported as CSV, each with the order of its rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators import reports
from wayfare.plans.layers import Layers
from wayfare.plans.questions import issue_counts


def daily_summary(layers: Layers) -> tuple[DataFrame, list[Column]]:
    return layers.daily, reports.ascending("pickup_date")


def top_pickup_zones(layers: Layers, k: int = 20) -> tuple[DataFrame, list[Column]]:
    top = reports.top_k(layers.zone, k, ["total_revenue"], ["location_id"])
    columns = top.select("borough", "zone", "total_pickup_trips", "total_revenue")
    return columns, [*reports.descending("total_revenue"), *reports.ascending("borough", "zone")]


def payment_behavior(layers: Layers) -> tuple[DataFrame, list[Column]]:
    return layers.payment, [
        *reports.descending("total_trips"),
        *reports.ascending("payment_type"),
    ]


def data_quality_issues(layers: Layers) -> tuple[DataFrame, list[Column]]:
    return issue_counts(layers), [
        F.col("issue_count").desc(),
        *reports.ascending("error_type"),
    ]


REPORTS = {
    report.__name__: report
    for report in (daily_summary, top_pickup_zones, payment_behavior, data_quality_issues)
}


def named_reports(layers: Layers) -> dict[str, tuple[DataFrame, list[Column]]]:
    return {name: report(layers) for name, report in REPORTS.items()}
