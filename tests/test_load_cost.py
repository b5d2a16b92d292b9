"""What a load spends on each trip: no printed digits, wide decimals or sorts where values are plain."""

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from wayfare.functions.numeric import cents_high, cents_low, double_to_money, double_to_whole
from wayfare.functions.temporal import day_name
from wayfare.plans import layers, refresh as module, silver
from wayfare.plans.layers import Layers
from wayfare.plans.refresh import refresh
from wayfare.sources import sinks
from wayfare.standin import trips as standin


def counted(table):
    return Counter(tuple(row) for row in table.collect())


def test_doubles_round_by_their_printed_digits(spark):
    pick = random.Random(1)
    doubles = [0.0, -0.0, 0.005, 1.005, 2.675, 1.0049999, 2.00499999999, 9_999_999_999.994, 9_999_999_999.985]
    doubles += [pick.randrange(10**12) / 1000 for _ in range(2000)]
    doubles += [pick.randrange(10**11) / 100 + pick.choice([0.005, -0.005]) for _ in range(2000)]
    doubles += [-x for x in doubles] + [None]
    table = spark.createDataFrame([(x,) for x in doubles], "x double")

    def nearest(x, step):
        return None if x is None else Decimal(repr(x)).quantize(Decimal(step), ROUND_HALF_UP) + 0

    found = table.select("x", double_to_money(F.col("x")).alias("money")).collect()
    assert [row["money"] for row in found] == [nearest(row["x"], "0.01") for row in found]
    small = table.where("x IS NULL OR abs(x) < 2e9").withColumn("x", F.col("x") + F.lit(0.5))
    found = small.select("x", double_to_whole(F.col("x")).alias("whole")).collect()
    assert [row["whole"] for row in found] == [nearest(row["x"], "1") for row in found]


def test_cents_of_the_largest_amounts(spark):
    values = [Decimal("9999999999.99"), Decimal("-9999999999.99"), Decimal("0.01"), Decimal("1234567890.29"), None]
    table = spark.createDataFrame([(x,) for x in values], "x decimal(12,2)")
    found = table.select(cents_high(F.col("x")), cents_low(F.col("x"))).collect()
    assert [None if high is None else high * 2**20 + low for high, low in found] == [
        None if x is None else int(x * 100) for x in values
    ]


def test_day_names(spark):
    moments = spark.range(800).select(F.expr("TIMESTAMP_NTZ'2025-01-01 23:59:59' + INTERVAL '1' DAY * id").alias("m"))
    assert moments.where(~day_name(F.col("m")).eqNullSafe(F.date_format("m", "EEEE"))).count() == 0


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return standin.layers(spark, sf_dir)


def loaded(raw, zones, root, monkeypatch):
    """The stored layers, and the plan by which trips were written."""
    plans, whole = {}, module.write_counted

    def watched(table, path, *args, **options):
        plans[path.rsplit("/", 1)[-1]] = table._jdf.queryExecution().optimizedPlan().toString()
        return whole(table, path, *args, **options)

    monkeypatch.setattr(module, "write_counted", watched)
    return refresh(raw, zones, str(root)), plans[layers.TRIPS.split(".")[1]]


@pytest.mark.parametrize("most", [0, 9_000_000_000.0])
def test_duplicates_are_compared_in_64_bits_where_they_fit(lazy, tmp_path, monkeypatch, most):
    step = F.col("step")
    copies = lazy.raw_trips.crossJoin(lazy.raw_trips.sparkSession.range(3).select(F.col("id").alias("step")))
    raw = copies.withColumns(
        {
            "fare_amount": F.when(F.col("pu_location_id") % 2 == 0, F.lit(7.25)).otherwise(10.004 - step + most),
            "tip_amount": F.when(F.col("do_location_id") % 2 == 0, 3.005 - step).otherwise(0.5) + F.lit(most),
            "payment_type": F.col("payment_type") * F.when(step == 1, -3).otherwise(5) + step,
        }
    ).drop("step")
    stored, plan = loaded(raw, lazy.raw_zones, tmp_path, monkeypatch)
    assert ("decimal(18,0)" in plan) is (most > 0)
    direct = Layers(raw, lazy.raw_zones)
    assert counted(stored.trips.select(*direct.trips.columns)) == counted(direct.trips)
    assert stored.trips.where("payment_type < 0").count() > 0


def test_widths_come_from_valid_trips():
    seen = {"most_fare": 99.995, "most_tip": None, "least_code": 1, "most_code": 6}
    assert silver.narrow_packing({name: None for name in seen})
    assert silver.narrow_packing(seen)
    assert silver.narrow_packing(seen | {"most_fare": 9e9, "most_tip": 9e9}) is None
    assert silver.narrow_packing(seen | {"least_code": -(2**63)}) is None


def test_partitioned_writes_keep_files_open_unless_the_session_says(spark, tmp_path, monkeypatch):
    before = spark.conf.get(sinks.FILES_AT_ONCE)
    table = spark.range(300).select("id", (F.col("id") % 20).cast("int").alias("part"))
    try:
        for given, used in (("0", "8"), ("3", "3")):
            spark.conf.set(sinks.FILES_AT_ONCE, given)
            with sinks._files_at_once(spark, 8):
                assert spark.conf.get(sinks.FILES_AT_ONCE) == used
            with pytest.raises(ZeroDivisionError), sinks._files_at_once(spark, 8):
                1 / 0
            # More values than open files: the rest is sorted.
            found = sinks.write_layer(table, f"{tmp_path}/{given}", ("part",))
            assert counted(found) == counted(table)
            assert spark.conf.get(sinks.FILES_AT_ONCE) == given
    finally:
        spark.conf.set(sinks.FILES_AT_ONCE, before)
