"""One row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Packing:
    """All columns outside a key as one number of fixed width that is ordered as they are.

    ``number`` makes it from the columns, ``columns`` finds them again in the one named
    ``PACKED``. The least number of a key is found in a hash map; the least of several
    columns takes a sort on both sides of the shuffle.
    """

    number: Column
    columns: Mapping[str, Column]


PACKED = "__packed"


def first_per_key(
    table: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str],
    nullable: Sequence[str] | None = None,
    packing: Packing | None = None,
    copies: str | None = None,
) -> DataFrame:
    """Keep one row per key, the least by ``tiebreak`` and then by the other columns.

    As in a unique constraint, NULLs are distinct: a row with a NULL in its key has no
    duplicates and stays. ``nullable`` names the key columns that can be NULL (all, when
    not given). Those rows skip the shuffle; Spark reads them in a scan of their own,
    with the IS NULL test pushed down to the files.

    The choice is an aggregate rather than a row number, so copies are folded before
    the shuffle and a key with very many copies never meets in one task. ``packing``, if
    given, must hold for every row. ``copies`` names a column to add: the rows that were
    folded into this one.
    """
    nullable = list(keys) if nullable is None else list(nullable)
    complete = [F.col(column).isNotNull() for column in nullable]
    keyed = table.where(reduce(lambda a, b: a & b, complete)) if complete else table
    kept = folded(keyed, keys, tiebreak, packing, copies)
    if not complete:
        return kept
    partial = [F.col(column).isNull() for column in nullable]
    return kept.unionByName(unfolded(table.where(reduce(lambda a, b: a | b, partial)), copies))


def folded(
    keyed: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[str],
    packing: Packing | None = None,
    copies: str | None = None,
) -> DataFrame:
    """One row per key of a table without NULLs in its key."""
    payload = list(tiebreak) + [
        column for column in keyed.columns if column not in keys and column not in tiebreak
    ]
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    names = [*keyed.columns, *([copies] if copies else [])]
    if packing:
        least = keyed.groupBy(*keys).agg(F.min(packing.number).alias(PACKED), *counted)
        found = {name: packing.columns[name].alias(name) for name in payload}
        return least.select(*[found.get(name, F.col(name)) for name in names])
    if payload:
        least = keyed.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("__kept"), *counted)
        return least.select(*keys, "__kept.*", *([copies] if copies else [])).select(*names)
    if copies:
        return keyed.groupBy(*keys).agg(*counted).select(*names)
    return keyed.select(*keys).distinct().select(*names)


def unfolded(table: DataFrame, copies: str | None = None) -> DataFrame:
    """Rows that have no duplicates, each a copy of its own."""
    return table.withColumn(copies, F.lit(1).cast("long")) if copies else table
