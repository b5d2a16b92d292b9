from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.session import CLUSTER_SETTINGS, SETTINGS, chosen_settings
from wayfare.functions.cleaning import nan_to_null, text_or, tokens_to_null
from wayfare.functions.labels import label_of
from wayfare.functions.numeric import (
    exact_mean,
    mean,
    money_text,
    ratio_or_zero,
    to_money,
    to_whole,
)
from wayfare.functions.temporal import day_name, day_part, is_weekend, minutes_between
from wayfare.profile import DAY_PARTS, PAYMENT_LABELS
from wayfare.schemas import NA_TOKENS


def values(spark, schema, rows, column):
    table = spark.createDataFrame([(row,) if not isinstance(row, tuple) else row for row in rows], schema)
    return [row[0] for row in table.select(column).collect()]


def test_passengers_round_halves_away_from_zero(spark):
    rows = [Decimal("0.4"), Decimal("0.5"), Decimal("1.5"), Decimal("2.5"), None]
    assert values(spark, "x decimal(18,6)", rows, to_whole(F.col("x"))) == [0, 1, 2, 3, None]


def test_money_rounds_halves_away_from_zero(spark):
    rows = [Decimal("2.345"), Decimal("1.005"), Decimal("-1.005"), Decimal("0.004")]
    expected = [Decimal("2.35"), Decimal("1.01"), Decimal("-1.01"), Decimal("0.00")]
    assert values(spark, "x decimal(18,6)", rows, to_money(F.col("x"))) == expected


def test_doubles_keep_their_printed_digits(spark):
    assert values(spark, "x double", [1.005, 2.675], to_money(F.col("x"))) == [
        Decimal("1.01"),
        Decimal("2.68"),
    ]


def test_money_text(spark):
    rows = [Decimal("1234567.125"), Decimal("0.005"), Decimal("12"), Decimal("-3.5"), None]
    expected = ["$1,234,567.13", "$0.01", "$12.00", "$-3.50", None]
    assert values(spark, "x decimal(18,3)", rows, money_text(F.col("x"))) == expected


def test_means(spark):
    rows = [(Decimal("10.00"), 4), (None, 0)]
    assert values(spark, "t decimal(22,2), n long", rows, mean(F.col("t"), F.col("n"))) == [2.5, None]
    third = exact_mean(F.col("t"), F.nullif(F.col("n"), F.lit(0)))
    assert values(spark, "t decimal(22,2), n long", [(Decimal("10.00"), 3)], third)[0] == pytest.approx(
        Decimal("3.333333333333")
    )


def test_ratio_is_zero_when_the_whole_is_not_positive(spark):
    rows = [(Decimal("1.00"), Decimal("4.00")), (Decimal("1.00"), Decimal("0.00"))]
    got = values(spark, "a decimal(12,2), b decimal(12,2)", rows, ratio_or_zero(F.col("a"), F.col("b")))
    assert [float(value) for value in got] == [0.25, 0.0]


def test_text_or(spark):
    rows = [" ", "", None, " Queens ", "A  B"]
    assert values(spark, "x string", rows, text_or(F.col("x"), "Unknown")) == [
        "Unknown",
        "Unknown",
        "Unknown",
        "Queens",
        "A  B",
    ]


def test_tokens_and_nan_become_null(spark):
    rows = ["N/A", "nan", "", None, "None", "Newark"]
    assert values(spark, "x string", rows, tokens_to_null(F.col("x"), NA_TOKENS)) == [None] * 5 + ["Newark"]
    assert values(spark, "x double", [float("nan"), 1.0, None], nan_to_null(F.col("x"), T.DoubleType())) == [
        None,
        1.0,
        None,
    ]


def test_day_parts(spark):
    rows = [4, 5, 10, 11, 15, 16, 20, 21]
    expected = ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night"]
    assert values(spark, "h int", rows, day_part(F.col("h"), DAY_PARTS, "Night")) == expected


def test_payment_labels(spark):
    rows = [0, 1, 2, 3, 4, 5, 6, 7]
    expected = ["Other", "Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip", "Other"]
    assert values(spark, "c long", rows, label_of(F.col("c"), PAYMENT_LABELS, "Other")) == expected


def test_weekend_and_day_name(spark):
    rows = [datetime(2026, 1, day, 12) for day in (2, 3, 4, 5)]
    assert values(spark, "t timestamp_ntz", rows, is_weekend(F.col("t"))) == [False, True, True, False]
    assert values(spark, "t timestamp_ntz", rows, day_name(F.col("t"))) == [
        "Friday",
        "Saturday",
        "Sunday",
        "Monday",
    ]


def minutes(spark, start, end):
    return values(
        spark, "a timestamp_ntz, b timestamp_ntz", [(start, end)], minutes_between(F.col("a"), F.col("b"))
    )[0]


@pytest.mark.parametrize(
    "micros, expected",
    [
        (200_000, "0.00"),
        (300_000, "0.01"),
        (299_999, "0.00"),
        (60_000_000, "1.00"),
        (90_300_000, "1.51"),
        (90_299_999, "1.50"),
        (5_000_000_000, "83.33"),
    ],
)
def test_minutes(spark, micros, expected):
    start = datetime(2026, 1, 1)
    assert minutes(spark, start, start + timedelta(microseconds=micros)) == Decimal(expected)


def test_minutes_ignore_daylight_saving(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert minutes(spark, datetime(2026, 3, 8, 1), datetime(2026, 3, 8, 4)) == Decimal("180.00")
        # 02:30 does not exist on that day in that zone, but it does on a clock without zone.
        assert minutes(spark, datetime(2026, 3, 8, 1), datetime(2026, 3, 8, 2, 30)) == Decimal("90.00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_settings_follow_the_master_and_the_user():
    zone = "spark.sql.session.timeZone"
    assert chosen_settings("local[8]", set()) == SETTINGS
    for master in ("yarn", "k8s://x", "spark://h:1", "local-cluster[2,1,1024]"):
        assert chosen_settings(master, set()) == CLUSTER_SETTINGS
        assert chosen_settings(master, {zone}) == {k: v for k, v in CLUSTER_SETTINGS.items() if k != zone}
