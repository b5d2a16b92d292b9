"""Row counts per stored object, and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUSES = ("SUCCESS", "FAILED")  # fixed values


def load_audit(objects: Mapping[str, DataFrame], status: str = "SUCCESS") -> DataFrame:
    """One row per object named ``layer.table``: how many rows it holds."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name.split(".")[0]).alias("layer_name"),
            F.lit(name).alias("object_name"),
            "row_count",
            F.lit(status).alias("status"),
        )
        for name, table in objects.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def logged(spark: SparkSession, counts: Mapping[str, int], status: str = "SUCCESS") -> DataFrame:
    """``load_audit`` of objects whose rows were counted while they were written."""
    rows = [(name.split(".")[0], name, rows, status) for name, rows in counts.items()]
    return spark.createDataFrame(
        rows, "layer_name string, object_name string, row_count bigint, status string"
    )


def balance(raw_rows: int, kept_rows: int, rejected_rows: int, folded_rows: int) -> dict:
    """Whether every raw row was kept, rejected or dropped as a duplicate.

    ``folded_rows`` are the rows that the kept ones were made of.
    """
    dropped = folded_rows - kept_rows
    adds_up = raw_rows == folded_rows + rejected_rows
    return {
        "raw_rows": raw_rows,
        "kept_rows": kept_rows,
        "rejected_rows": rejected_rows,
        "dropped_rows": dropped,
        "status": "SUCCESS" if adds_up else "FAILED",
    }


def row_conservation(outcomes: DataFrame, kept: DataFrame) -> DataFrame:
    """The same of tables, as one row. ``outcomes`` has ``raw_rows`` and ``rejected_rows``,
    ``kept`` has ``kept_rows`` and ``dropped_rows``; each has one row, found apart from the other,
    so the check is real."""
    names = ("raw_rows", "kept_rows", "rejected_rows", "dropped_rows")
    rows = outcomes.select("raw_rows", "rejected_rows").unionByName(
        kept.select("kept_rows", "dropped_rows"), allowMissingColumns=True
    )
    both = rows.agg(*[F.max(name).alias(name) for name in names])
    balanced = F.col("raw_rows") == F.col("kept_rows") + F.col("rejected_rows") + F.col("dropped_rows")
    return both.select(*names, F.when(balanced, "SUCCESS").otherwise("FAILED").alias("status"))
