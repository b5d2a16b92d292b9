"""Raw tables to cleaned zones, cleaned trips and rejected trips."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.cleaning import text_or
from wayfare.functions.labels import label_of
from wayfare.functions.numeric import (
    LEAST_MONEY,
    LEAST_WHOLE,
    TOO_MUCH_MONEY,
    TOO_MUCH_WHOLE,
    cents_to_money,
    double_to_cents,
    double_to_money,
    double_to_whole,
)
from wayfare.functions.temporal import (
    LEAST_DURATION,
    day_name,
    day_part,
    in_window,
    is_weekend,
    minutes_between,
    ntz,
)
from wayfare.operators.dedup import PACKED, Packing, first_per_key, folded, unfolded
from wayfare.operators.lookup import LookupSize, lookup_join
from wayfare.operators.rules import Rule, first_failure, negative, not_positive, passes
from wayfare.profile import DEFAULT_PROFILE, TripProfile
from wayfare.schemas import CLEANED_TRIPS

_PICKUP = "tpep_pickup_datetime"
_DROPOFF = "tpep_dropoff_datetime"

# Rules of this library; the other names of rules below are fixed values.
ROUNDS_TO_ZERO = "rounds_to_zero"
EXCEEDS_RANGE = "exceeds_range"
NO_ROOM = "a positive count, distance or duration rounds to zero, or a value is too large"


def clean_zones(raw_zones: DataFrame, profile: TripProfile = DEFAULT_PROFILE) -> DataFrame:
    """Trimmed names, blanks named, exact copies dropped, rows without id left out."""
    names = [
        text_or(F.col(column), profile.missing_name).alias(column)
        for column in ("borough", "zone", "service_zone")
    ]
    return raw_zones.where(F.col("location_id").isNotNull()).select("location_id", *names).distinct()


# --- rules ------------------------------------------------------------------------


def _own_rules() -> list[Rule]:
    """Rules on a trip's own columns, in order."""
    pickup, dropoff = F.col(_PICKUP), F.col(_DROPOFF)
    return [
        Rule("missing_datetime", pickup.isNull() | dropoff.isNull()),
        Rule("invalid_duration", dropoff <= pickup),
        not_positive("invalid_passenger_count", "passenger_count"),
        not_positive("invalid_trip_distance", "trip_distance"),
        negative("negative_fare", "fare_amount"),
        negative("negative_tip", "tip_amount"),
        negative("negative_total_amount", "total_amount"),
    ]


def _window_rule(profile: TripProfile) -> Rule:
    inside = in_window(F.col(_PICKUP), ntz(profile.window_start), ntz(profile.window_end))
    return Rule(profile.window_error, ~inside)


def _range_rule() -> Rule:
    """Values, infinity among them, that the cleaned columns have no room for."""
    too_large = F.col("passenger_count") >= F.lit(TOO_MUCH_WHOLE)
    for column in ("trip_distance", "fare_amount", "tip_amount", "total_amount"):
        too_large = too_large | (F.col(column) >= F.lit(TOO_MUCH_MONEY))
    return Rule(EXCEEDS_RANGE, too_large)


def _rounding_rule() -> Rule:
    """Positive values that the cleaned columns would show as zero.

    Written as bounds on the raw values, which are cheaper than rounding and reach the scan.
    """
    duration = F.col(_DROPOFF) - F.col(_PICKUP)
    vanishes = (
        (F.col("passenger_count") < F.lit(LEAST_WHOLE))
        | (F.col("trip_distance") < F.lit(LEAST_MONEY))
        | (duration < F.lit(LEAST_DURATION))
    )
    return Rule(ROUNDS_TO_ZERO, vanishes)


def _zone_flag(ids: DataFrame, column: str, flag: str) -> DataFrame:
    return ids.select(F.col("location_id").alias(column), F.lit(True).alias(flag))


def trip_rules(profile: TripProfile = DEFAULT_PROFILE) -> list[Rule]:
    """All rules in order, over a trip with its two zone flags."""
    return [
        *_own_rules(),
        Rule("unknown_pickup_location", F.col("pickup_known").isNull()),
        Rule("unknown_dropoff_location", F.col("dropoff_known").isNull()),
        _window_rule(profile),
        _range_rule(),
        _rounding_rule(),
    ]


def classify(
    raw_trips: DataFrame,
    zones: DataFrame,
    size: LookupSize,
    profile: TripProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """Every raw trip with the name of its first failing rule in ``error_type``."""
    flagged = lookup_join(
        raw_trips, _zone_flag(zones, "pu_location_id", "pickup_known"), "pu_location_id", "left", size
    )
    flagged = lookup_join(
        flagged, _zone_flag(zones, "do_location_id", "dropoff_known"), "do_location_id", "left", size
    )
    outcome = flagged.withColumn("error_type", first_failure(trip_rules(profile)))
    return outcome.select(*raw_trips.columns, "error_type")


# Where a classified trip goes on: rejected, searched for duplicates, or unique as it is.
ROUTE = "route"
REJECTED, KEYED, SINGLE = "rejected", "keyed", "single"


def with_route(classified: DataFrame) -> DataFrame:
    """Trips as far as a later table needs them, with ``ROUTE`` as the last column."""
    route = (
        F.when(F.col("error_type").isNotNull(), REJECTED)
        .when(F.col("vendor_id").isNull(), SINGLE)
        .otherwise(KEYED)
    )
    return classified.select(*_ROUTED, "error_type", route.alias(ROUTE))


_ROUTED = (
    "vendor_id",
    _PICKUP,
    _DROPOFF,
    "passenger_count",
    "trip_distance",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "source_file",
)


def lacks_room() -> Column:
    """Trips rejected for a value that the cleaned columns cannot hold: errors when strict."""
    return F.col("error_type").isin(EXCEEDS_RANGE, ROUNDS_TO_ZERO)


def rejected_trips(classified: DataFrame, profile: TripProfile = DEFAULT_PROFILE) -> DataFrame:
    """Trips that fail a rule, with the reason."""
    return classified.where(F.col("error_type").isNotNull()).select(
        "error_type",
        F.lit(profile.rejection_note).alias("error_description"),
        "vendor_id",
        F.col(_PICKUP).alias("pickup_datetime"),
        F.col(_DROPOFF).alias("dropoff_datetime"),
        F.col("pu_location_id").alias("pickup_location_id"),
        F.col("do_location_id").alias("dropoff_location_id"),
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "source_file",
    )


def valid_trips(
    raw_trips: DataFrame,
    zones: DataFrame,
    size: LookupSize,
    profile: TripProfile = DEFAULT_PROFILE,
) -> DataFrame:
    """Trips that pass every rule: the exact complement of the rejected ones.

    Written as filters and semi joins, not as ``error_type IS NULL``: the comparisons
    reach the file scan and skip row groups, for example those outside the window.
    """
    plain = passes([*_own_rules(), _window_rule(profile)])
    kept = raw_trips.where(plain)
    for column in ("pu_location_id", "do_location_id"):
        ids = zones.select(F.col("location_id").alias(column))
        kept = lookup_join(kept, ids, column, "left_semi", size)
    unfit = [_range_rule(), _rounding_rule()]
    if profile.strict:
        stop = F.raise_error(F.lit(NO_ROOM))
        failed = unfit[0].fails | unfit[1].fails
        return kept.where(F.when(failed, stop.cast("boolean")).otherwise(F.lit(True)))
    return kept.where(passes(unfit))


# --- cleaned trips ----------------------------------------------------------------


def rounded_trips(
    valid: DataFrame, money: Callable[[Column], Column] = double_to_money
) -> DataFrame:
    """Final names and rounded measures: all that the natural key is made of. ``money`` rounds
    amounts and distances, to decimals or to whole cents."""
    return valid.select(
        "vendor_id",
        F.col(_PICKUP).alias("pickup_datetime"),
        F.col(_DROPOFF).alias("dropoff_datetime"),
        double_to_whole(F.col("passenger_count")).alias("passenger_count"),
        money(F.col("trip_distance")).alias("trip_distance"),
        F.col("pu_location_id").alias("pickup_location_id"),
        F.col("do_location_id").alias("dropoff_location_id"),
        F.coalesce(F.col("payment_type"), F.lit(0)).alias("payment_type"),
        money(F.col("fare_amount")).alias("fare_amount"),
        money(F.col("tip_amount")).alias("tip_amount"),
        money(F.col("total_amount")).alias("total_amount"),
    )


# Payment codes within this distance of 0 fit the packed form below.
MOST_CODE = 5 * 10**11
_HALF, _CODES = 10**6, 10**12


def codes_fit(least: Column, largest: Column) -> Column:
    """Whether all payment codes between two can be packed; none at all can."""
    return F.coalesce((least >= -MOST_CODE) & (largest < MOST_CODE), F.lit(True))


def _whole_part(number: Column, by: Column) -> Column:
    """Exact division of whole numbers, rounded down."""
    return F.call_function("div", number, by)


def _packing() -> Packing:
    """Fare, tip and payment code, in this order, as one number of 36 digits: 12 for the cents
    of the fare, 12 for those of the tip, and 12 for the code, moved to be positive."""
    fare, tip = (
        (F.col(name) * F.lit(100)).cast("long") for name in ("fare_amount", "tip_amount")
    )
    upper = fare * _HALF + _whole_part(tip, F.lit(_HALF))
    lower = (tip % _HALF) * _CODES + F.col("payment_type") + MOST_CODE
    whole = F.lit(Decimal(10**18))
    number = upper.cast(T.DecimalType(18, 0)) * whole + lower.cast(T.DecimalType(18, 0))
    packed = F.col(PACKED)
    high = _whole_part(packed, whole)
    low = (packed % whole).cast("long")
    money = cents_to_money
    return Packing(
        number.cast(T.DecimalType(38, 0)),
        {
            "fare_amount": money(_whole_part(high, F.lit(_HALF))),
            "tip_amount": money((high % _HALF) * _HALF + _whole_part(low, F.lit(_CODES))),
            "payment_type": low % _CODES - MOST_CODE,
        },
    )


def payload_metrics() -> dict[str, Column]:
    """Aggregates over classified trips that bound fare, tip and payment code of the valid ones."""
    valid = F.col("error_type").isNull()
    code = F.when(valid, F.col("payment_type"))
    return {
        "most_fare": F.max(F.when(valid, F.col("fare_amount"))),
        "most_tip": F.max(F.when(valid, F.col("tip_amount"))),
        "least_code": F.min(code),
        "most_code": F.max(code),
    }


def narrow_packing(seen: Mapping[str, Any]) -> Packing | None:
    """``_packing`` of cents in 64 bits, as wide as the values of ``payload_metrics`` need; none
    if they need more. Fare and tip are whole cents here."""
    # A missing code counts as 0. One cent more than the largest amount covers its rounding.
    least = min(seen["least_code"] or 0, 0)
    codes = max(seen["most_code"] or 0, 0) - least + 1
    fares, tips = (math.ceil((seen[name] or 0) * 100) + 2 for name in ("most_fare", "most_tip"))
    if fares * tips * codes >= 2**63:
        return None
    tip_code = F.lit(tips * codes).cast("long"), F.lit(codes).cast("long")
    number = (
        F.col("fare_amount") * tip_code[0]
        + F.col("tip_amount") * tip_code[1]
        + (F.col("payment_type") - F.lit(least).cast("long"))
    )
    packed = F.col(PACKED)
    return Packing(
        number,
        {
            "fare_amount": _whole_part(packed, tip_code[0]),
            "tip_amount": _whole_part(packed % tip_code[0], tip_code[1]),
            "payment_type": packed % tip_code[1] + F.lit(least).cast("long"),
        },
    )


_TIEBREAK = ("fare_amount", "tip_amount", "payment_type")
_MONEY_COLUMNS = ("trip_distance", "fare_amount", "tip_amount", "total_amount")
COPIES = "__copies"


def unique_of_routes(
    keyed: DataFrame,
    single: DataFrame,
    profile: TripProfile = DEFAULT_PROFILE,
    packed: bool = False,
    copies: str | None = None,
    narrow: Packing | None = None,
) -> DataFrame:
    """``unique_trips`` of valid trips that were routed before: those with a vendor, and those
    without, which have no duplicates. With ``narrow`` amounts are whole cents until then."""
    if narrow:
        cents = folded(
            rounded_trips(keyed, double_to_cents), profile.trip_key, _TIEBREAK, narrow, copies
        )
        cents = cents.unionByName(unfolded(rounded_trips(single, double_to_cents), copies))
        return cents.withColumns({name: cents_to_money(F.col(name)) for name in _MONEY_COLUMNS})
    kept = folded(
        rounded_trips(keyed), profile.trip_key, _TIEBREAK, _packing() if packed else None, copies
    )
    return kept.unionByName(unfolded(rounded_trips(single), copies))


def unique_trips(
    rounded: DataFrame,
    profile: TripProfile = DEFAULT_PROFILE,
    packed: bool = False,
    copies: str | None = None,
) -> DataFrame:
    """One trip per natural key; only the vendor can be missing in it.

    ``packed`` says that all payment codes fit (see ``codes_fit``); then no sort is needed.
    """
    return first_per_key(
        rounded,
        profile.trip_key,
        tiebreak=_TIEBREAK,
        nullable=("vendor_id",),
        packing=_packing() if packed else None,
        copies=copies,
    )


def _derived(profile: TripProfile) -> dict[str, Column]:
    pickup = F.col("pickup_datetime")
    return {
        "pickup_date": F.to_date(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day_name": day_name(pickup),
        "is_weekend": is_weekend(pickup),
        "time_period": day_part(F.hour(pickup), profile.day_parts, profile.other_day_part),
        "trip_duration_minutes": minutes_between(pickup, F.col("dropoff_datetime")),
        "payment_label": label_of(
            F.col("payment_type"), profile.payment_labels, profile.other_payment
        ),
    }


def cleaned_columns(
    names: Sequence[str], profile: TripProfile = DEFAULT_PROFILE
) -> list[Column]:
    """Columns of the cleaned trips, as expressions over ``unique_trips``."""
    derived = _derived(profile)
    return [(derived[name] if name in derived else F.col(name)).alias(name) for name in names]


def enrich_trips(trips: DataFrame, profile: TripProfile = DEFAULT_PROFILE) -> DataFrame:
    """Add calendar parts, duration and payment name.

    All of them follow from other columns, so they are added after the duplicates are
    gone and the shuffle does not carry them.
    """
    return trips.select(*cleaned_columns(CLEANED_TRIPS.names, profile))


def cleaned_trips(
    raw_trips: DataFrame,
    zones: DataFrame,
    size: LookupSize,
    profile: TripProfile = DEFAULT_PROFILE,
    packed: bool = False,
) -> DataFrame:
    valid = valid_trips(raw_trips, zones, size, profile)
    return enrich_trips(unique_trips(rounded_trips(valid), profile, packed), profile)


def with_row_id(table: DataFrame, name: str) -> DataFrame:
    """Add a surrogate key: unique, with gaps, and no shuffle to number the rows.

    It depends on how the rows are split, so it is given once, when the layer is written.
    """
    return table.select(F.monotonically_increasing_id().alias(name), "*")
