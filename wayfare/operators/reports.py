"""Report operators: top-k, ranks, shares, running values, outliers.

Running totals, moving means and changes put a whole ordered table in one window unless
``within`` names groups. They are meant for marts by date, whose row count is set by the
calendar and does not grow with the trips. Ranks over a whole table are shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.operators.lookup import LookupSize, lookup_join
from wayfare.operators.ranks import with_percent_rank, with_rank
from wayfare.sources.sinks import stored

RANKINGS = {
    "row_number": F.row_number,
    "rank": F.rank,
    "dense_rank": F.dense_rank,
}


def descending(*columns: str) -> list[Column]:
    """Largest first, missing values last."""
    return [F.col(column).desc_nulls_last() for column in columns]


def ascending(*columns: str) -> list[Column]:
    return [F.col(column).asc_nulls_last() for column in columns]


def top_k(table: DataFrame, k: int, by: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows; ``ties`` makes the order total."""
    return table.orderBy(*descending(*by), *ascending(*ties)).limit(k)


def top_k_per_group(
    table: DataFrame,
    k: int,
    group: str,
    by: Sequence[str],
    ties: Sequence[str] = (),
    method: str = "row_number",
    rank: str = "rank",
) -> DataFrame:
    """The first ``k`` ranks of each group.

    Spark limits each group before the shuffle, as the filter on the rank is applied
    right after the window.
    """
    order = Window.partitionBy(group).orderBy(*descending(*by), *ascending(*ties))
    ranked = table.withColumn(rank, RANKINGS[method]().over(order).cast("long"))
    return ranked.where(F.col(rank) <= k)


def rank_all(table: DataFrame, by: str, rank: str, method: str = "rank") -> DataFrame:
    """All rows ranked by ``by``, the largest first; ``method`` is rank or dense_rank."""
    table = stored(table, "ranked")
    return with_rank(table, by, descending(by), rank, method)


def percentiles_of(table: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Relative ranks from 0 (least) to 1 (largest); ``names`` maps each new column to the one
    that it ranks. The table is stored and counted once for all of them."""
    ranked = table = stored(table, "ranked")
    rows = table.count()
    for name, by in names.items():
        ranked = with_percent_rank(ranked, by, ascending(by), name, rows)
    return ranked


def percentile_of(table: DataFrame, by: str, name: str) -> DataFrame:
    """Relative rank from 0 (least) to 1 (largest)."""
    return percentiles_of(table, {name: by})


def running_total(
    table: DataFrame, order: str, value: str, name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Total of all rows up to this one; rows equal in ``order`` count together."""
    window = Window.partitionBy(*within).orderBy(*ascending(order))
    return table.withColumn(name, F.sum(value).over(window))


def moving_mean(
    table: DataFrame,
    order: str,
    value: str,
    name: str,
    rows: int = 7,
    within: Sequence[str] = (),
) -> DataFrame:
    """Mean of this row and the ``rows - 1`` before it (rows, not days)."""
    window = Window.partitionBy(*within).orderBy(*ascending(order)).rowsBetween(1 - rows, 0)
    return table.withColumn(name, F.avg(F.col(value).cast("double")).over(window))


def change_from_previous(
    table: DataFrame,
    order: str,
    value: str,
    previous: str,
    change: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Value of the row before, and the difference; both NULL on the first row."""
    window = Window.partitionBy(*within).orderBy(*ascending(order))
    return table.withColumn(previous, F.lag(value, 1).over(window)).withColumn(
        change, F.col(value) - F.col(previous)
    )


def versus_mean(table: DataFrame, value: str, mean: str, difference: str) -> DataFrame:
    """Each value beside the mean of all. The mean is a scalar subquery: one row, no window."""
    overall = table.agg((F.sum(value).cast("double") / F.count(value)).alias(mean))
    return table.withColumn(mean, overall.scalar()).withColumn(
        difference, F.col(value).cast("double") - F.col(mean)
    )


def share_of_total(table: DataFrame, value: str, share: str) -> DataFrame:
    """Part of the grand total; NULL when the total is 0."""
    total = table.agg(F.sum(value).cast("double"))
    return table.withColumn(share, F.try_divide(F.col(value).cast("double"), total.scalar()))


def below_share(table: DataFrame, value: str, share: Decimal) -> DataFrame:
    """Rows with less than ``share`` of the grand total, compared without dividing."""
    total = table.agg(F.sum(value))
    return table.where(F.col(value) < total.scalar() * F.lit(share))


def outliers(table: DataFrame, value: str, deviations: float = 2.0, floor: float = 0.0) -> DataFrame:
    """Rows further than ``deviations`` population standard deviations from the mean.

    The lower bound never goes below ``floor``.
    """
    centre, width = F.avg(value), F.stddev_pop(value) * deviations
    upper = table.agg(centre + width)
    lower = table.agg(F.greatest(centre - width, F.lit(floor)))
    return table.where((F.col(value) > upper.scalar()) | (F.col(value) < lower.scalar()))


def above_group_mean(
    table: DataFrame, group: str, value: str, mean: str, size: LookupSize
) -> DataFrame:
    """Rows whose value exceeds the mean of their group.

    The means are one small row per group and are joined to the table, which avoids the
    sort of the whole table that a window would take and does not mind a group that
    holds a third of the rows. ``size`` is the measured size of the lookup table that
    bounds the number of groups.
    """
    sums = table.groupBy(group).agg(F.sum(value).alias("__sum"), F.count(value).alias("__count"))
    means = sums.withColumn(mean, F.col("__sum").cast("double") / F.col("__count"))
    joined = lookup_join(table, means, group, "inner", size)
    # Compared without dividing: values equal to the mean are not above it.
    above = joined.where(F.col(value) * F.col("__count") > F.col("__sum"))
    return above.drop("__sum", "__count")
