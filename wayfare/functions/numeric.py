"""Exact rounding, means and money text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.schemas import MONEY


# Positive values below these become zero when they are rounded.
LEAST_MONEY = 0.005
LEAST_WHOLE = 0.5

# Values from these on do not fit ``MONEY`` or an integer once they are rounded.
TOO_MUCH_MONEY = 9_999_999_999.995
TOO_MUCH_WHOLE = 2_147_483_647.5


def to_money(value: Column) -> Column:
    """Two decimals, rounded once: a decimal cast takes the digits a double is printed with
    and rounds halves away from zero."""
    return value.cast(MONEY)


def to_whole(value: Column) -> Column:
    """Nearest integer, halves away from zero (a plain cast to int would truncate)."""
    return value.cast(T.DecimalType(12, 0)).cast("int")


def double_to_cents(value: Column) -> Column:
    """The cents of ``to_money`` of a double, as a whole number.

    Reading a double's printed digits takes longest. They only matter near half a cent: below 10^10
    they and the product lie less than 0.001 cents from the value, so elsewhere the nearest whole
    number is the same.
    """
    scaled = value * F.lit(100.0)
    whole = F.rint(scaled)
    clear = (F.abs(scaled - whole) < F.lit(0.49)) & (F.abs(scaled) < F.lit(1e12))
    return F.when(clear, whole.cast("long")).otherwise(_cents(to_money(value)))


def cents_to_money(cents: Column) -> Column:
    return (cents.cast(T.DecimalType(12, 0)) * F.lit(Decimal("0.01"))).cast(MONEY)


def double_to_money(value: Column) -> Column:
    """``to_money`` of a double, with the same digits."""
    return cents_to_money(double_to_cents(value))


def double_to_whole(value: Column) -> Column:
    """``to_whole`` of a double: printed digits are read only near a half."""
    whole = F.rint(value)
    clear = (F.abs(value - whole) < F.lit(0.49)) & (F.abs(value) < F.lit(1e9))
    return F.when(clear, whole.cast("int")).otherwise(to_whole(value))


# Cents are added up as two whole numbers. A ``MONEY`` value has less than 10^12 cents, so both
# parts of one stay below 2^20, and 64 bits hold their sums over 2^43 (8.8 * 10^12) rows.
_PART_BITS = 20
_PART = 1 << _PART_BITS


def cents_high(value: Column) -> Column:
    """Whole parts of 2^20 cents in a ``MONEY`` value, rounded down."""
    return F.shiftright(_cents(value), _PART_BITS)


def cents_low(value: Column) -> Column:
    """The cents beside ``cents_high``: 0 to 2^20 - 1."""
    return _cents(value).bitwiseAND(F.lit(_PART - 1).cast("long"))


def _cents(value: Column) -> Column:
    """Below 10^12 cents the product as a double lies within 0.001 of the whole number."""
    return F.rint(value.cast("double") * F.lit(100.0)).cast("long")


def cents_total(high: Column, low: Column) -> Column:
    """The exact sum of amounts, of the sums of both parts."""
    whole = T.DecimalType(19, 0)
    cents = high.cast(whole) * F.lit(Decimal(_PART)) + low.cast(whole)
    return (cents * F.lit(Decimal("0.01"))).cast(T.DecimalType(38, 2))


def mean(total: Column, count: Column) -> Column:
    """Mean from an exact decimal total: the same however the rows were split."""
    return F.when(count > 0, total.cast("double") / count)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where the whole is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0))


def exact_mean(total: Column, count: Column) -> Column:
    """Mean as a decimal, with room for an exact rounding to cents."""
    return total.cast(T.DecimalType(28, 2)) / count.cast(T.DecimalType(18, 0))


def money_text(value: Column) -> Column:
    """``$1,234.50``. Rounded first: ``format_number`` alone rounds halves to even."""
    return F.concat(F.lit("$"), F.format_number(F.round(value, 2), 2))
