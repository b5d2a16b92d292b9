"""Derive raw trips and zones from the tables lineitem, orders, customer, supplier,
nation and region (mapping in FIXTURES.md). Each line item becomes one trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.plans.layers import Layers
from wayfare.profile import DEFAULT_PROFILE, TripProfile
from wayfare.schemas import RAW_TRIPS, RAW_ZONES
from wayfare.sources.ingest import align

SOURCE_FILE = "lineitem.parquet"


def _rounded(value: str) -> str:
    """``round(value)`` of a double. It reads the printed digits, which only matter near a half."""
    return f"IF(abs({value} - rint({value})) < 0.49D, rint({value}), round({value}))"


def _mills(value: str) -> str:
    """Thousandths as the double nearest to them. A division is that double as long as both numbers
    are exact, which all whole numbers of 15 digits are; longer ones have no decimal(15,0)."""
    exact = f"CAST(CAST({value} AS DECIMAL(15,0)) * {_MILL} AS DOUBLE)"
    return f"IF({value} BETWEEN {1 - 10**15}L AND {10**15 - 1}L, ({value}) / 1000D, {exact})"


_MILL = "CAST(0.001 AS DECIMAL(4,3))"


# Formulas of the mapping as Spark SQL, in two steps. ``h`` spreads the line items over
# all cases; ``fm``, ``tm`` are fare and tip in thousandths, ``dp`` the tip percentage.
_PARTS = [
    "l_linenumber",
    "l_quantity",
    "c_nationkey",
    "s_nationkey",
    "(l_orderkey * 7919L + l_partkey * 104729L + l_suppkey * 1299709L"
    " + l_linenumber * 15485863L) % 1000003L AS h",
    f"CAST({_rounded('l_extendedprice')} AS BIGINT) AS fm",
    f"CAST({_rounded('abs(l_discount) * 100')} AS BIGINT) AS dp",
]
_SCALED = [
    "*",
    # Outside the generator, so that a filter on the vendor reaches the line items.
    "IF(h % 53 = 0, NULL, l_linenumber) AS vendor_id",
    "fm * dp DIV IF(c_nationkey = 3, 400, 100) AS tm",
    "TIMESTAMP_NTZ'2025-12-31 00:00:00' + INTERVAL '1' SECOND * (((h DIV 7) % 33) * 86400"
    " + IF(h % 2 = 0, 61200 + h % 9000, (h * 37) % 86400)) AS start_at",
]
_DISTANCE = (
    "IF(abs(l_quantity - rint(l_quantity)) < 0.49D AND abs(l_quantity) < 1e12D,"
    " (CAST(rint(l_quantity) AS BIGINT) * 1000L + h % 1000) / 1000D,"
    " CAST(CAST(l_quantity AS DECIMAL(15,0))"
    f" + CAST(h % 1000 AS DECIMAL(15,0)) * {_MILL} AS DOUBLE))"
)
_TRIP = {
    "tpep_pickup_datetime": "IF(h % 211 = 0, NULL, start_at)",
    "tpep_dropoff_datetime": "CASE WHEN h % 223 = 0 THEN NULL"
    " WHEN h % 101 = 0 THEN start_at - INTERVAL '60' SECOND"
    " ELSE start_at + INTERVAL '1' SECOND * (60 + (h * 13) % 5400) END",
    "passenger_count": "CASE WHEN h % 89 = 0 THEN NULL WHEN h % 97 = 0 THEN 0D"
    " WHEN h % 83 = 0 THEN 1.5D WHEN h % 79 = 0 THEN 2.5D"
    " ELSE CAST(1 + h % 6 AS DOUBLE) END",
    "trip_distance": "CASE WHEN h % 103 = 0 THEN 0D WHEN h % 67 = 0 THEN 0.0049999D"
    " WHEN h % 179 = 0 THEN 4e-7D "
    f"ELSE {_DISTANCE} END",
    "pu_location_id": "CASE WHEN h % 127 = 0 THEN 999 WHEN c_nationkey = 24 THEN 3"
    " WHEN c_nationkey % 5 = 4 AND h % 5 <> 0 THEN c_nationkey - 1 ELSE c_nationkey END",
    "do_location_id": "IF(h % 131 = 0, 998, s_nationkey)",
    "payment_type": "IF(h % 61 = 0, NULL, h % 7)",
    "fare_amount": "CASE WHEN h % 137 = 0 THEN -4e-7D WHEN h % 139 = 0 THEN 2e12D"
    " WHEN h % 149 = 0 THEN 1.0049999D WHEN h % 151 = 0 THEN 1.005D"
    f" ELSE {_mills('IF(h % 107 = 0, -fm, fm)')} END",
    "tip_amount": "IF(h % 157 = 0, 2.00499999999D,"
    f" {_mills('IF(h % 109 = 0, -1, tm)')})",
    "total_amount": "IF(h % 163 = 0, 1e15D,"
    f" {_mills('IF(h % 113 = 0, -1, fm + tm + 2500)')})",
    "source_file": f"'{SOURCE_FILE}'",
}

#: Columns that the stand-in leaves to the alignment.
ABSENT = tuple(name for name in RAW_TRIPS.names if name not in ("vendor_id", *_TRIP))


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Line items and orders grow together and outgrow any broadcast: always a shuffle join,
    # whose tasks share the work that follows also when the input is one small file.
    joined = (
        read("lineitem")
        .join(read("orders").hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(read("customer"), F.expr("o_custkey = c_custkey"))
        .join(read("supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    scaled = joined.selectExpr(*_PARTS).selectExpr(*_SCALED)
    trip = ", ".join(f"'{name}', {formula}" for name, formula in _TRIP.items())
    # Some trips arrive twice. Filters of later layers stay above the generator and refer
    # to finished columns, as they would for a stored table, and do not repeat formulas.
    copies = f"array_repeat(named_struct({trip}), IF(h % 71 = 0, 2, 1))"
    return align(scaled.selectExpr("vendor_id", f"inline({copies})"), RAW_TRIPS)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    key, name = F.col("n_nationkey"), F.col("r_name")
    zones = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        key.alias("location_id"),
        F.when(name == "ASIA", "  Asia ").otherwise(name).alias("borough"),
        F.when(key == 7, "   ").when(key != 12, F.col("n_name")).alias("zone"),
        F.when(key % 2 == 0, "Yellow Zone").otherwise("").alias("service_zone"),
        F.lit("nation.parquet").alias("source_file"),
    )
    nameless = spark.sql(
        "SELECT CAST(NULL AS INT) AS location_id, 'X' AS borough, 'X' AS zone, "
        "'X' AS service_zone, 'nation.parquet' AS source_file"
    )
    return align(
        zones.unionByName(zones.where(F.col("location_id") == 5)).unionByName(nameless), RAW_ZONES
    )


def layers(spark: SparkSession, sf_dir: str, profile: TripProfile = DEFAULT_PROFILE) -> Layers:
    return Layers(raw_trips(spark, sf_dir), raw_zones(spark, sf_dir), profile)
