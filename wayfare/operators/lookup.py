"""Joins of a large table with a lookup table of checked size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class LookupSize:
    """Measured size of a lookup table, and what follows from it for joins."""

    rows: int
    bytes: int
    max_rows: int = MAX_BROADCAST_ROWS
    max_bytes: int = MAX_BROADCAST_BYTES

    @property
    def fits(self) -> bool:
        return self.rows <= self.max_rows and self.bytes <= self.max_bytes


class DuplicateKeyError(ValueError):
    """A lookup key occurs more than once, so a join would multiply rows."""


def measure_lookup(
    lookup: DataFrame,
    key: str,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> LookupSize:
    """Count a lookup table once, and refuse it if its key is not unique.

    One row comes back to the driver. Only the lookup is read, never the table that
    will be joined with it.
    """
    width = F.lit(8 * len(lookup.columns)).cast("long")
    for column in lookup.schema.fields:
        if isinstance(column.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(column.name), F.lit(0))
    per_key = lookup.groupBy(key).agg(
        F.count(F.lit(1)).alias("copies"), F.sum(width).alias("bytes")
    )
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count(F.when(F.col("copies") > 1, 1)).alias("repeated"),
    ).first()
    if totals["repeated"]:
        raise DuplicateKeyError(f"{totals['repeated']} values of {key} occur more than once")
    return LookupSize(totals["rows"], totals["bytes"], max_rows, max_bytes)


def lookup_join(
    table: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str,
    size: LookupSize,
) -> DataFrame:
    """Join ``table`` with a lookup that is unique on ``on``.

    A lookup that fits is broadcast and the table is not shuffled. One that does not is
    joined by a sort merge join. A key that holds a third of the table makes one large
    shuffle partition, which adaptive execution cuts by map task into parts of the advisory
    size, however many these are; each part meets the lookup rows of that partition.
    """
    return table.join(lookup_hint(lookup, size), on, how)


def lookup_hint(lookup: DataFrame, size: LookupSize) -> DataFrame:
    """``lookup`` with the way it is to be joined."""
    return F.broadcast(lookup) if size.fits else lookup.hint("merge")
