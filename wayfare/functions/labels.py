"""Code to name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_of(code: Column, labels: dict[int, str], other: str) -> Column:
    named = F.lit(other)
    for value, name in labels.items():
        named = F.when(code == value, name).otherwise(named)
    return named
