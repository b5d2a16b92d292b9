"""Constraint checks: what a database would refuse on write, found by query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.lookup import LookupSize, lookup_join


def repeated_keys(table: DataFrame, keys: Sequence[str], nulls_distinct: bool = False) -> DataFrame:
    """Keys that occur more than once, with ``copies``.

    A primary key must not be NULL either: such keys are listed too, unless
    ``nulls_distinct`` asks for the meaning of a unique constraint, where a NULL repeats
    nothing.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    rows = table.where(~any_null) if nulls_distinct else table
    copies = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    bad = F.col("copies") > 1
    return copies.where(bad if nulls_distinct else bad | any_null)


def key_counts(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``distinct_keys``, and ``violations`` (keys that are repeated or not complete)."""
    complete = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    copies = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.count(F.when(complete, 1)).alias("distinct_keys"),
        F.count(F.when((F.col("copies") > 1) | ~complete, 1)).alias("violations"),
    )


def orphans(table: DataFrame, column: str, lookup: DataFrame, key: str, size: LookupSize) -> DataFrame:
    """Rows whose ``column`` is set and not in the lookup. NULL refers to nothing."""
    ids = lookup.select(F.col(key).alias(column))
    return lookup_join(table.where(F.col(column).isNotNull()), ids, column, "left_anti", size)


def count_where(table: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Number of rows per check in one pass: columns ``check_name`` and ``violations``."""
    names = list(checks)
    counted = table.agg(*[F.count(F.when(checks[name], 1)).alias(name) for name in names])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("violations")) for name in names]
    )
    return counted.select(F.inline(pairs))


def null_counts(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return count_where(table, {column: F.col(column).isNull() for column in columns})


def range_violations(table: DataFrame, allowed: Mapping[str, Column]) -> DataFrame:
    """Rows outside each allowed range; a NULL breaks no range."""
    return count_where(table, {name: ~condition for name, condition in allowed.items()})
