"""Ranks over a whole table, by many tasks.

Rows of equal value have equal ranks, so the values are ranked and not the rows: they are
counted (a value that a third of the rows has is one row of counts), dealt to tasks by ranges,
and stored with the number of their range. A rank is then the rows of the ranges before, plus
those before the value within its range, plus one. As a value is in one range only, ties never
meet a border. Ranks are joined back by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.sources.sinks import stored

METHODS = ("rank", "dense_rank")
MOST_RANGES = 1_000  # the table of ranges has a row for each; it is broadcast


def _range_count(table: DataFrame) -> int:
    return min(MOST_RANGES, int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def rows_before(
    table: DataFrame, by: str, order: Sequence[Column], method: str = "rank"
) -> DataFrame:
    """Each value of ``by`` with ``__before``: rows (or, for dense ranks, values) ahead of it."""
    ranges = _range_count(table)
    size = F.count(F.lit(1)) if method == "rank" else F.lit(1).cast("long")
    counted = table.groupBy(by).agg(size.alias("__size"))
    dealt = counted.repartitionByRange(ranges, *order)
    # Stored: the number of a row's range must be the same wherever it is read.
    dealt = stored(dealt.withColumn("__range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("__range").agg(F.sum("__size").alias("__total"))
    later = F.explode(F.sequence(F.col("__range") + 1, F.lit(ranges - 1))).alias("__range")
    ahead = (
        totals.where(F.col("__range") < ranges - 1)
        .select(later, "__total")
        .groupBy("__range")
        .agg(F.sum("__total").alias("__ahead"))
    )
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__size").over(within), F.lit(0))
    before = F.coalesce(F.col("__ahead"), F.lit(0)) + inside
    return dealt.join(F.broadcast(ahead), "__range", "left").select(by, before.alias("__before"))


def with_rank(
    table: DataFrame, by: str, order: Sequence[Column], name: str, method: str = "rank"
) -> DataFrame:
    """``table`` with the rank of each row's ``by`` in ``order``, as a window without partitions
    would give it.

    ``table`` is read twice; store it first if it is costly to derive.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    ranks = rows_before(table, by, order, method).select(
        F.col(by).alias("__value"), (F.col("__before") + 1).alias(name)
    )
    joined = table.join(ranks, table[by].eqNullSafe(ranks["__value"]))
    return joined.select(*table.columns, name)


def with_percent_rank(
    table: DataFrame, by: str, order: Sequence[Column], name: str, rows: int
) -> DataFrame:
    """``table`` with the relative rank from 0 (first) to 1; ``rows`` is its row count."""
    ranked = with_rank(table, by, order, name)
    relative = (F.col(name) - 1) / F.lit(float(max(rows - 1, 1)))
    return ranked.withColumn(name, relative)
