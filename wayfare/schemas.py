"""Column names and types of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

MEASURE = T.DoubleType()  # raw amounts and distances, as the files hold them
MONEY = T.DecimalType(12, 2)  # rounded amounts, distances and minutes


def _fields(spec: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec.items()])


# Column lists of the raw and cleaned tables.
RAW_TRIPS = _fields(
    {
        "vendor_id": T.IntegerType(),
        "tpep_pickup_datetime": T.TimestampNTZType(),
        "tpep_dropoff_datetime": T.TimestampNTZType(),
        "passenger_count": MEASURE,
        "trip_distance": MEASURE,
        "ratecode_id": MEASURE,
        "store_and_fwd_flag": T.StringType(),
        "pu_location_id": T.IntegerType(),
        "do_location_id": T.IntegerType(),
        "payment_type": T.LongType(),
        "fare_amount": MEASURE,
        "extra": MEASURE,
        "mta_tax": MEASURE,
        "tip_amount": MEASURE,
        "tolls_amount": MEASURE,
        "improvement_surcharge": MEASURE,
        "total_amount": MEASURE,
        "congestion_surcharge": MEASURE,
        "airport_fee": MEASURE,
        "cbd_congestion_fee": MEASURE,
        "source_file": T.StringType(),
    }
)

RAW_ZONES = _fields(
    {
        "location_id": T.IntegerType(),
        "borough": T.StringType(),
        "zone": T.StringType(),
        "service_zone": T.StringType(),
        "source_file": T.StringType(),
    }
)

CLEANED_TRIPS = _fields(
    {
        "vendor_id": T.IntegerType(),
        "pickup_datetime": T.TimestampNTZType(),
        "dropoff_datetime": T.TimestampNTZType(),
        "pickup_date": T.DateType(),
        "pickup_hour": T.IntegerType(),
        "pickup_day_name": T.StringType(),
        "is_weekend": T.BooleanType(),
        "time_period": T.StringType(),
        "trip_duration_minutes": MONEY,
        "passenger_count": T.IntegerType(),
        "trip_distance": MONEY,
        "pickup_location_id": T.IntegerType(),
        "dropoff_location_id": T.IntegerType(),
        "payment_type": T.LongType(),
        "payment_label": T.StringType(),
        "fare_amount": MONEY,
        "tip_amount": MONEY,
        "total_amount": MONEY,
    }
)

# As stored: a load without a valid trip writes no file that would tell the columns.
STORED_TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.LongType(), True),
        *CLEANED_TRIPS.fields,
        T.StructField("loaded_at", T.TimestampType(), True),
    ]
)

# Spelling of the source columns that change name.
TRIP_RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
}
ZONE_RENAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}

# CSV cells that mean "no value".
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
