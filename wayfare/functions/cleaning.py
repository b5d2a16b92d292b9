"""Null and text clean-up."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(value: Column, kind: T.DataType) -> Column:
    """NaN passes every ``> 0`` test in Spark, so it must go before any rule."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def tokens_to_null(value: Column, tokens: Iterable[str]) -> Column:
    return F.when(~value.isin(*tokens), value)


def text_or(value: Column, default: str) -> Column:
    """Trimmed text; blank and missing become ``default``."""
    return F.coalesce(F.nullif(F.trim(value), F.lit("")), F.lit(default))
