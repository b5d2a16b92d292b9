"""Durations and calendar parts on wall-clock timestamps."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.schemas import MONEY

_SECONDS = T.DayTimeIntervalType(T.DayTimeIntervalType.SECOND, T.DayTimeIntervalType.SECOND)

# Shorter trips round to zero minutes.
LEAST_DURATION = timedelta(milliseconds=300)


def minutes_between(start: Column, end: Column) -> Column:
    """Minutes between two times without zone, two decimals, halves up.

    Spark divides intervals with whole microseconds and rounds halves up. Divided by
    600,000 a microsecond count is hundredths of a minute; times 10,000, and read as
    seconds, these are the minutes. No zone and no floating point takes part.
    """
    scaled = (end - start) / F.lit(600_000) * F.lit(10_000)
    return scaled.cast(_SECONDS).cast(MONEY)


def in_window(moment: Column, start: Column, end: Column) -> Column:
    """Half-open: the start belongs to the window, the end does not."""
    return (moment >= start) & (moment < end)


def ntz(moment) -> Column:
    """A timestamp without zone as a literal."""
    return F.lit(moment.isoformat(sep=" ")).cast(T.TimestampNTZType())


_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_name(moment: Column) -> Column:
    """Looked up rather than formatted, which takes a calendar for each row."""
    return F.get(F.array(*[F.lit(name) for name in _DAYS]), F.weekday(moment))


def is_weekend(moment: Column) -> Column:
    """Saturday or Sunday (``weekday`` counts from Monday = 0)."""
    return F.weekday(moment).isin(5, 6)


def day_part(hour: Column, parts: dict[str, tuple[int, int]], other: str) -> Column:
    label = F.lit(other)
    for name, (first, last) in parts.items():
        label = F.when(hour.between(first, last), name).otherwise(label)
    return label
