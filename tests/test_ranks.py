"""Ranks by many tasks against a window over the whole table."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayfare.operators import reports
from wayfare.operators.ranks import with_rank
from wayfare.plans import questions
from wayfare.standin import trips as standin

SCHEMA = "id int, whole long, money decimal(38,2), part double, word string, day date"


def values(kind, rng, size):
    """Few values and many ties, NULLs among them; half of the rows have the same one."""
    some = {
        "whole": [None, *range(-3, 8)],
        "money": [None, *[Decimal(n) / 100 for n in range(-40, 200, 7)]],
        "part": [None, float("nan"), float("inf"), -0.0, 0.0, 1.5, -2.25],
        "word": [None, "", "a", "b", "é", "漢"],
    }[kind]
    return [rng.choice(some) if rng.random() < 0.5 else some[2] for _ in range(size)]


@pytest.fixture(scope="module", params=[0, 1, 700])
def table(spark, request):
    rng = random.Random(request.param)
    size = request.param
    columns = [values(kind, rng, size) for kind in ("whole", "money", "part", "word")]
    rows = [(n, *row) for n, row in enumerate(zip(*columns))]
    return spark.createDataFrame(rows, "id int, whole long, money decimal(38,2), part double, word string").repartition(5)


COLUMNS = ("whole", "money", "part", "word")


def collected(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


@pytest.mark.parametrize("by", COLUMNS)
@pytest.mark.parametrize("method", ["rank", "dense_rank"])
def test_rank_equals_the_window(table, by, method):
    whole = Window.orderBy(F.col(by).desc_nulls_last())
    expected = table.withColumn("r", getattr(F, method)().over(whole).cast("long"))
    found = reports.rank_all(table, by, "r", method)
    assert found.schema["r"].dataType == expected.schema["r"].dataType
    assert collected(found, "id", "r") == collected(expected, "id", "r")


@pytest.mark.parametrize("by", COLUMNS)
def test_percent_rank_equals_the_window(table, by):
    expected = table.withColumn("p", F.percent_rank().over(Window.orderBy(F.col(by).asc_nulls_last())))
    assert collected(reports.percentile_of(table, by, "p"), "id", "p") == collected(expected, "id", "p")


def test_two_percentiles_at_once(table):
    names = {"p": "whole", "q": "money"}
    expected = table
    for name, by in names.items():
        expected = expected.withColumn(name, F.percent_rank().over(Window.orderBy(F.col(by).asc_nulls_last())))
    assert collected(reports.percentiles_of(table, names), "id", "p", "q") == collected(expected, "id", "p", "q")


def test_many_values_are_dealt_to_many_tasks(spark):
    rng = random.Random(1)
    table = spark.createDataFrame([(n, rng.randrange(10**9)) for n in range(5_000)], "id int, v long")
    found = reports.rank_all(table, "v", "r")
    order = sorted((v for _, v in table.collect()), reverse=True)
    assert all(order[row.r - 1] == row.v for row in found.collect())
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    ranges = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__range" in ranges and int(parts) > 1


def test_unknown_method(table):
    with pytest.raises(ValueError, match="method"):
        with_rank(table, "whole", reports.descending("whole"), "r", "row_number")


@pytest.mark.parametrize("question", [questions.zone_ranking, questions.busy_low_tip_zones])
def test_no_question_ranks_in_one_task(spark, sf_dir, question):
    frame = question(standin.layers(spark, sf_dir))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    frame.collect()
    assert "SinglePartition" not in frame._jdf.queryExecution().executedPlan().toString()
