"""Sums of amounts in whole numbers of fixed width."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wayfare.functions.numeric import cents_high, cents_low, cents_total
from wayfare.plans import gold
from wayfare.standin import trips as standin

LARGEST = Decimal("9999999999.99")
VALUES = [Decimal(v) for v in ("0.00", "0.01", "10485.75", "10485.76", "10485.77", "12.34")] + [LARGEST]


def test_parts_give_the_value_again(spark):
    values = [*VALUES, *[-v for v in VALUES], None]
    table = spark.createDataFrame([(v,) for v in values], "v decimal(12,2)")
    parts = table.select("v", cents_high(F.col("v")).alias("h"), cents_low(F.col("v")).alias("l"))
    rows = parts.select("*", cents_total(F.col("h"), F.col("l")).alias("t")).collect()
    assert all(r.t == r.v for r in rows)
    assert all(0 <= r.l < 2**20 and abs(r.h) <= 2**20 for r in rows if r.v is not None)


def test_totals_of_the_largest_parts(spark):
    """What 2^43 rows of the largest amount add up to is still exact."""
    high, low = 2**63 - 1, 2**63 - 1
    row = spark.createDataFrame([(high, low)], "h long, l long").select(cents_total(F.col("h"), F.col("l"))).first()
    assert row[0] == Decimal(high * 2**20 + low) / 100


def test_sums_beyond_64_bits_of_cents(spark):
    """Ten million trips of the largest amount: their cents do not fit 64 bits."""
    trips = spark.range(1_000).select(F.lit(LARGEST).cast("decimal(12,2)").alias("v"))
    sums = trips.select(
        (F.sum(cents_high(F.col("v"))) * 10_000).alias("h"), (F.sum(cents_low(F.col("v"))) * 10_000).alias("l")
    )
    total = sums.select(cents_total(F.col("h"), F.col("l"))).first()[0]
    assert total == LARGEST * 10_000_000 and total * 100 > 2**63


@pytest.mark.parametrize("name", ["daily", "hourly", "zone", "route"])
def test_marts_add_fixed_width_numbers(spark, sf_dir, name):
    lazy = standin.layers(spark, sf_dir)
    plan = getattr(lazy, name)._jdf.queryExecution().executedPlan()
    frame = gold.unit_sums(lazy.trips)
    kinds = {f.name: f.dataType.simpleString() for f in gold.roll_up(frame).schema.fields}
    assert {kind for column, kind in kinds.items() if column != "sum_tip_ratio"} == {"bigint"}
    lines = [line for line in plan.toString().splitlines() if "partial_sum" in line]
    assert lines and not any("sum_tip_ratio" in line for line in lines)
    assert "SortAggregate" not in plan.toString()


def test_marts_equal_decimal_sums(spark, sf_dir):
    lazy = standin.layers(spark, sf_dir)
    expected = lazy.trips.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("total_amount", "fare_amount", "tip_amount")]
    )
    expected = {r.pickup_date: r for r in expected.collect()}
    found = lazy.daily.collect()
    assert len(found) == len(expected)
    for row in found:
        own = expected[row.pickup_date]
        assert (row.total_trips, row.total_revenue) == (own.n, own.total_amount)
        assert row.avg_fare == float(own.fare_amount) / own.n and row.avg_tip == float(own.tip_amount) / own.n
