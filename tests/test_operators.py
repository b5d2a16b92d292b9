"""Report, join, dedup and check operators on small tables."""

from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfare.operators import audit, quality, reports
from wayfare.operators.dedup import PACKED, Packing, first_per_key
from wayfare.operators.lookup import LookupSize, lookup_join
from wayfare.operators.rules import Rule, first_failure, passes


def rows(table):
    return [tuple(row) for row in table.collect()]


SMALL = LookupSize(3, 100)
LARGE = LookupSize(3, 100, max_rows=0)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_merge_join_equals_broadcast_join(spark, how):
    """Most rows share one key, as they may at scale."""
    table = spark.range(0, 2000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).alias("k"), "id"
    )
    lookup = spark.createDataFrame([(1, "one"), (2, "two"), (9, "nine")], "k long, name string")
    plain = lookup_join(table, lookup, "k", how, SMALL)
    merged = lookup_join(table, lookup, "k", how, LARGE)
    assert plain.columns == merged.columns
    assert Counter(rows(plain)) == Counter(rows(merged))
    assert "BroadcastExchange" in plain._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, 1]), st.integers(0, 3)), min_size=1
    )
)
def test_first_per_key(spark, data):
    table = spark.createDataFrame(data, "a int, b int, x int").repartition(3)
    best, free = {}, []
    for a, b, x in data:
        if a is None or b is None:
            free.append((a, b, x))
        else:
            best[a, b] = min(x, best.get((a, b), x))
    expected = free + [(*key, x) for key, x in best.items()]
    assert Counter(rows(first_per_key(table, ["a", "b"], ["x"]))) == Counter(expected)


@pytest.mark.parametrize("packed", [False, True])
def test_first_per_key_counts_copies(spark, packed):
    data = [(1, 5), (1, 3), (1, 4), (2, 7), (None, 1), (None, 1)]
    table = spark.createDataFrame(data, "a int, x int").repartition(3)
    packing = Packing(F.col("x").cast("long"), {"x": F.col(PACKED).cast("int")}) if packed else None
    found = first_per_key(table, ["a"], ["x"], packing=packing, copies="n")
    assert found.columns == ["a", "x", "n"]
    assert Counter(rows(found)) == Counter([(1, 3, 3), (2, 7, 1), (None, 1, 1), (None, 1, 1)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("SortAggregate" in plan) is not packed


def test_first_per_key_without_other_columns(spark):
    table = spark.createDataFrame([(1,), (1,), (None,), (None,)], "a int")
    assert Counter(rows(first_per_key(table, ["a"], []))) == Counter([(1,), (None,), (None,)])
    assert Counter(rows(first_per_key(table, ["a"], [], nullable=[]))) == Counter([(1,), (None,)])


def test_unknown_outcome_is_a_pass(spark):
    rules = [Rule("x_negative", F.col("x") < 0, settled=False), Rule("y_missing", F.col("y").isNull())]
    table = spark.createDataFrame([(None, 1), (-1, None), (1, None), (None, None)], "x int, y int")
    got = rows(table.select(first_failure(rules), passes(rules)))
    assert got == [(None, True), ("x_negative", False), ("y_missing", False), ("y_missing", False)]


def test_no_rules(spark):
    assert rows(spark.range(1).select(first_failure([]), passes([]))) == [(None, True)]


def test_top_k_breaks_ties_by_key(spark):
    table = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, None), (5, 9)], "id int, v int")
    assert rows(reports.top_k(table, 3, ["v"], ["id"])) == [(5, 9), (1, 5), (2, 5)]
    assert rows(reports.top_k(table, 9, ["v"], ["id"]))[-1] == (4, None)


@pytest.mark.parametrize(
    "method, ties, expected",
    [
        ("row_number", ["id"], [(1, 1), (2, 2)]),
        ("rank", [], [(1, 1), (2, 1)]),
        ("dense_rank", [], [(1, 1), (2, 1), (3, 2)]),
    ],
)
def test_top_k_per_group(spark, method, ties, expected):
    table = spark.createDataFrame([("g", 1, 5), ("g", 2, 5), ("g", 3, 4), ("g", 4, 1)], "g string, id int, v int")
    top = reports.top_k_per_group(table, 2, "g", ["v"], ties, method)
    assert rows(top.select("id", "rank").orderBy("id")) == expected


def test_rank_all_puts_missing_last(spark):
    table = spark.createDataFrame([(1, None), (2, 7), (3, 7), (4, 1)], "id int, v int")
    got = reports.rank_all(table, "v", "r").orderBy("id").select("r")
    assert rows(got) == [(4,), (1,), (1,), (3,)]


def days(spark, *values, gap_after=None):
    start = date(2026, 1, 1)
    dates = [start + timedelta(days=i + (5 if gap_after and i > gap_after else 0)) for i in range(len(values))]
    return spark.createDataFrame(list(zip(dates, values)), "d date, v long")


def test_moving_mean_counts_rows_not_days(spark):
    table = days(spark, *range(1, 10), gap_after=3)
    got = [row.m for row in reports.moving_mean(table, "d", "v", "m").orderBy("d").collect()]
    assert got == [1, 1.5, 2, 2.5, 3, 3.5, 4, 5, 6]


def test_running_total_and_change(spark):
    table = days(spark, 5, 3, 4)
    assert [row.s for row in reports.running_total(table, "d", "v", "s").orderBy("d").collect()] == [5, 8, 12]
    changed = reports.change_from_previous(table, "d", "v", "p", "c").orderBy("d")
    assert rows(changed.select("p", "c")) == [(None, None), (5, -2), (3, 1)]


def test_running_total_within_groups(spark):
    table = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 1, 5)], "g string, o int, v int")
    got = reports.running_total(table, "o", "v", "s", within=["g"]).orderBy("g", "o").select("s")
    assert rows(got) == [(1,), (3,), (5,)]


def test_versus_mean_and_share(spark):
    table = days(spark, 1, 2, 6)
    assert rows(reports.versus_mean(table, "v", "m", "x").orderBy("d").select("m", "x")) == [
        (3.0, -2.0),
        (3.0, -1.0),
        (3.0, 3.0),
    ]
    shares = [row.s for row in reports.share_of_total(table, "v", "s").orderBy("d").collect()]
    assert sum(shares) == pytest.approx(1) and shares[0] == pytest.approx(1 / 9)
    assert rows(reports.share_of_total(days(spark, 0, 0), "v", "s").select("s")) == [(None,), (None,)]


def test_outliers_on_both_sides(spark):
    """Twenty hours at 100, one at 1, one at 400: mean 109.1, deviation 66.7 (by hand), so
    the bounds are 0 (floored) and 242.4; with one deviation they are 42.4 and 175.7."""
    table = spark.createDataFrame([(100,)] * 20 + [(1,), (400,)], "v long")
    assert rows(reports.outliers(table, "v")) == [(400,)]
    assert sorted(rows(reports.outliers(table, "v", deviations=1))) == [(1,), (400,)]


@pytest.mark.parametrize("size", [SMALL, LARGE])
def test_above_group_mean(spark, size):
    table = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 7)], "g string, v int")
    got = reports.above_group_mean(table, "g", "v", "m", size)
    assert rows(got.select("g", "v", "m")) == [("a", 3, 2.0)]


def test_percentile(spark):
    table = spark.createDataFrame([(v,) for v in (10, 20, 30, 40, 50)], "v int")
    got = reports.percentile_of(table, "v", "p").orderBy("v").select("p")
    assert rows(got) == [(0.0,), (0.25,), (0.5,), (0.75,), (1.0,)]


def test_constraint_checks(spark):
    table = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None)], "k int, s string")
    assert sorted(rows(quality.repeated_keys(table, ["k"])), key=str) == [(1, 2), (None, 2)]
    assert rows(quality.repeated_keys(table, ["k"], nulls_distinct=True)) == [(1, 2)]
    lookup = spark.createDataFrame([(1,)], "id int")
    for size in (SMALL, LARGE):
        assert rows(quality.orphans(table, "k", lookup, "id", size)) == [(2, None)]
    assert dict(rows(quality.null_counts(table, ["k", "s"]))) == {"k": 2, "s": 1}
    assert dict(rows(quality.range_violations(table, {"k": F.col("k") > 1}))) == {"k": 2}


def test_load_audit(spark):
    table = audit.load_audit({"bronze.a": spark.range(3), "gold.b": spark.range(0)})
    assert rows(table.orderBy("object_name")) == [
        ("bronze", "bronze.a", 3, "SUCCESS"),
        ("gold", "gold.b", 0, "SUCCESS"),
    ]
    with pytest.raises(ValueError):
        audit.load_audit({"bronze.a": spark.range(3)}, status="DONE")


def test_row_conservation(spark):
    kept = spark.createDataFrame([(4, 3)], "kept_rows long, dropped_rows long")
    for raw, status in ((10, "SUCCESS"), (11, "FAILED")):
        outcomes = spark.createDataFrame([(raw, 3)], "raw_rows long, rejected_rows long")
        found = audit.row_conservation(outcomes, kept).first()
        assert tuple(found) == (raw, 4, 3, 3, status)
        assert audit.balance(raw, 4, 3, 7) == found.asDict()


def test_equal_values_are_not_above_their_mean(spark):
    table = spark.createDataFrame(
        [(1, Decimal("0.10"))] * 3 + [(2, Decimal("0.10")), (2, Decimal("0.11"))],
        "g long, v decimal(12,2)",
    )
    for size in (SMALL, LARGE):
        above = reports.above_group_mean(table, "g", "v", "m", size)
        assert [(r["g"], r["v"]) for r in above.collect()] == [(2, Decimal("0.11"))]


def test_a_share_of_exactly_the_bound_is_not_below_it(spark):
    table = spark.createDataFrame(
        [("a", Decimal("0.30")), ("b", Decimal("0.29")), ("c", Decimal("5.41"))],
        "name string, v decimal(22,2)",
    )
    assert rows(reports.below_share(table, "v", Decimal("0.05")).select("name")) == [("b",)]
    assert rows(reports.below_share(table.limit(0), "v", Decimal("0.05"))) == []


def test_hot_key_of_a_large_lookup_is_split(spark):
    """Adaptive execution cuts the partition of a hot key; the rows stay the same."""
    low = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in low}
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        table = spark.range(0, 400_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000).alias("k"), "id"
        )
        joined = lookup_join(table, spark.range(500).select(F.col("id").alias("k")), "k", "left_semi", LARGE)
        kept = table.where(F.col("k") < 500)
        assert joined.agg(F.sum("id"), F.count("id")).first() == kept.agg(F.sum("id"), F.count("id")).first()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
