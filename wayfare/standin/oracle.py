"""DuckDB SQL for every registered query, written apart from the Spark code.

All statements share the CTEs below, from the star-schema tables to the marts; DuckDB
computes only those that a statement uses.
"""

from __future__ import annotations

_RAW = """
WITH joined AS (
    SELECT l_linenumber, l_quantity, c_nationkey, s_nationkey,
           (l_orderkey * 7919 + l_partkey * 104729 + l_suppkey * 1299709
            + l_linenumber::BIGINT * 15485863) % 1000003 AS h,
           round(l_extendedprice)::BIGINT AS fm,
           round(abs(l_discount) * 100)::BIGINT AS dp
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
),
timed AS (
    SELECT *,
           fm * dp // (CASE WHEN c_nationkey = 3 THEN 400 ELSE 100 END) AS tm,
           TIMESTAMP '2025-12-31 00:00:00' + to_seconds(
               ((h // 7) % 33) * 86400
               + CASE WHEN h % 2 = 0 THEN 61200 + h % 9000 ELSE (h * 37) % 86400 END) AS start_at
    FROM joined
),
once AS (
    SELECT h,
           CASE WHEN h % 53 <> 0 THEN l_linenumber END AS vendor_id,
           CASE WHEN h % 211 <> 0 THEN start_at END AS p,
           CASE WHEN h % 223 = 0 THEN NULL
                WHEN h % 101 = 0 THEN start_at - to_seconds(60)
                ELSE start_at + to_seconds(60 + (h * 13) % 5400) END AS d,
           CASE WHEN h % 89 = 0 THEN NULL
                WHEN h % 97 = 0 THEN 0
                WHEN h % 83 = 0 THEN 1.5
                WHEN h % 79 = 0 THEN 2.5
                ELSE 1 + h % 6 END::DOUBLE AS passengers,
           CASE WHEN h % 103 = 0 THEN 0
                WHEN h % 67 = 0 THEN 0.0049999::DOUBLE
                WHEN h % 179 = 0 THEN 4e-7::DOUBLE
                ELSE (l_quantity::DECIMAL(15, 0)
                      + (h % 1000)::DECIMAL(15, 0) * 0.001::DECIMAL(4, 3))::VARCHAR::DOUBLE END AS distance,
           CASE WHEN h % 137 = 0 THEN -4e-7::DOUBLE
                WHEN h % 139 = 0 THEN 2e12::DOUBLE
                WHEN h % 149 = 0 THEN 1.0049999::DOUBLE
                WHEN h % 151 = 0 THEN 1.005::DOUBLE
                ELSE (CASE WHEN h % 107 = 0 THEN -fm ELSE fm END::DECIMAL(15, 0)
                      * 0.001::DECIMAL(4, 3))::VARCHAR::DOUBLE END AS fare,
           CASE WHEN h % 157 = 0 THEN 2.00499999999::DOUBLE
                ELSE (CASE WHEN h % 109 = 0 THEN -1 ELSE tm END::DECIMAL(15, 0)
                      * 0.001::DECIMAL(4, 3))::VARCHAR::DOUBLE END AS tip,
           CASE WHEN h % 163 = 0 THEN 1e15::DOUBLE
                ELSE (CASE WHEN h % 113 = 0 THEN -1 ELSE fm + tm + 2500 END::DECIMAL(15, 0)
                      * 0.001::DECIMAL(4, 3))::VARCHAR::DOUBLE END AS total,
           CASE WHEN h % 127 = 0 THEN 999
                WHEN c_nationkey = 24 THEN 3
                WHEN c_nationkey % 5 = 4 AND h % 5 <> 0 THEN c_nationkey - 1
                ELSE c_nationkey END::INTEGER AS pu,
           CASE WHEN h % 131 = 0 THEN 998 ELSE s_nationkey END::INTEGER AS dropoff,
           CASE WHEN h % 61 <> 0 THEN h % 7 END AS pay
    FROM timed
),
raw AS (
    SELECT * FROM once UNION ALL SELECT * FROM once WHERE h % 71 = 0
),
raw_zones AS (
    SELECT n_nationkey AS location_id,
           CASE WHEN r_name = 'ASIA' THEN '  Asia ' ELSE r_name END AS borough,
           CASE n_nationkey WHEN 7 THEN '   ' WHEN 12 THEN NULL ELSE n_name END AS zone,
           CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE '' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL
    SELECT n_nationkey, CASE WHEN r_name = 'ASIA' THEN '  Asia ' ELSE r_name END, n_name, ''
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey = 5
    UNION ALL
    SELECT NULL, 'X', 'X', 'X'
),
"""



def cents(value: str) -> str:
    """Two decimals, rounded once from the printed digits; NULL where they do not fit."""
    return f"TRY_CAST(TRY_CAST({value}::VARCHAR AS DECIMAL(38, 18)) AS DECIMAL(12, 2))"


_SILVER = f"""
zones AS (
    SELECT DISTINCT location_id,
           coalesce(nullif(trim(borough), ''), 'Unknown') AS borough,
           coalesce(nullif(trim(zone), ''), 'Unknown') AS zone,
           coalesce(nullif(trim(service_zone), ''), 'Unknown') AS service_zone
    FROM raw_zones WHERE location_id IS NOT NULL
),
checked AS (
    SELECT r.*,
           round(passengers, 0)::INTEGER AS passenger_count,
           {cents('distance')} AS trip_distance,
           ((epoch_us(d) - epoch_us(p)) * 100 + 30000000) // 60000000 AS hundredths,
           pu IN (SELECT location_id FROM zones) AS pu_ok,
           dropoff IN (SELECT location_id FROM zones) AS do_ok
    FROM raw r
),
classified AS (
    SELECT *, CASE
        WHEN p IS NULL OR d IS NULL THEN 'missing_datetime'
        WHEN d <= p THEN 'invalid_duration'
        WHEN passengers IS NULL OR passengers <= 0 THEN 'invalid_passenger_count'
        WHEN distance IS NULL OR distance <= 0 THEN 'invalid_trip_distance'
        WHEN fare IS NULL OR fare < 0 THEN 'negative_fare'
        WHEN tip IS NULL OR tip < 0 THEN 'negative_tip'
        WHEN total IS NULL OR total < 0 THEN 'negative_total_amount'
        WHEN pu_ok IS NOT TRUE THEN 'unknown_pickup_location'
        WHEN do_ok IS NOT TRUE THEN 'unknown_dropoff_location'
        WHEN p < TIMESTAMP '2026-01-01' OR p >= TIMESTAMP '2026-02-01' THEN 'outside_january_2026'
        WHEN passengers >= 2147483647.5 OR greatest(distance, fare, tip, total) >= 9999999999.995
            THEN 'exceeds_range'
        WHEN passenger_count <= 0 OR trip_distance <= 0 OR hundredths <= 0 THEN 'rounds_to_zero'
        END AS error_type
    FROM checked
),
issues AS (
    SELECT error_type, 'Record rejected during bronze to silver validation' AS error_description,
           vendor_id, p AS pickup_datetime, d AS dropoff_datetime, pu AS pickup_location_id,
           dropoff AS dropoff_location_id, passengers AS passenger_count,
           distance AS trip_distance, fare AS fare_amount, tip AS tip_amount,
           total AS total_amount, 'lineitem.parquet' AS source_file
    FROM classified WHERE error_type IS NOT NULL
),
valid AS (
    SELECT vendor_id, p AS pickup_datetime, d AS dropoff_datetime, passenger_count, trip_distance,
           pu AS pickup_location_id, dropoff AS dropoff_location_id, coalesce(pay, 0) AS payment_type,
           {cents('fare')} AS fare_amount,
           {cents('tip')} AS tip_amount,
           {cents('total')} AS total_amount,
           (hundredths::DECIMAL(15, 0) * 0.01::DECIMAL(3, 2))::DECIMAL(12, 2) AS trip_duration_minutes
    FROM classified WHERE error_type IS NULL
),
numbered AS (
    SELECT *, row_number() OVER (
        PARTITION BY vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id,
                     dropoff_location_id, passenger_count, trip_distance, total_amount
        ORDER BY fare_amount, tip_amount, payment_type) AS copy
    FROM valid
),
trips AS (
    SELECT * EXCLUDE (copy),
           pickup_datetime::DATE AS pickup_date,
           extract(hour FROM pickup_datetime)::INTEGER AS pickup_hour,
           dayname(pickup_datetime) AS pickup_day_name,
           isodow(pickup_datetime) IN (6, 7) AS is_weekend,
           CASE WHEN extract(hour FROM pickup_datetime) BETWEEN 5 AND 10 THEN 'Morning'
                WHEN extract(hour FROM pickup_datetime) BETWEEN 11 AND 15 THEN 'Afternoon'
                WHEN extract(hour FROM pickup_datetime) BETWEEN 16 AND 20 THEN 'Evening'
                ELSE 'Night' END AS time_period,
           CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
                WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
                ELSE 'Other' END AS payment_label
    FROM numbered WHERE copy = 1 OR vendor_id IS NULL
),
"""

_GOLD = """
daily AS (
    SELECT pickup_date, count(*) AS total_trips, sum(total_amount) AS total_revenue,
           sum(total_amount)::DOUBLE / count(*) AS avg_revenue,
           sum(fare_amount)::DOUBLE / count(*) AS avg_fare,
           sum(tip_amount)::DOUBLE / count(*) AS avg_tip,
           sum(trip_distance)::DOUBLE / count(*) AS avg_distance,
           sum(trip_duration_minutes)::DOUBLE / count(*) AS avg_duration_minutes
    FROM trips GROUP BY pickup_date
),
hourly AS (
    SELECT pickup_date, pickup_hour, time_period, count(*) AS total_trips,
           sum(total_amount) AS total_revenue,
           sum(trip_duration_minutes)::DOUBLE / count(*) AS avg_duration_minutes
    FROM trips GROUP BY pickup_date, pickup_hour, time_period
),
per_zone AS (
    SELECT pickup_location_id AS location_id, count(*) AS n, sum(total_amount) AS revenue,
           sum(fare_amount) AS fares, sum(tip_amount) AS tips, sum(trip_distance) AS distance
    FROM trips GROUP BY ALL
),
zone AS (
    SELECT location_id, borough, zone, coalesce(n, 0) AS total_pickup_trips, revenue AS total_revenue,
           fares::DOUBLE / n AS avg_fare, tips::DOUBLE / n AS avg_tip, distance::DOUBLE / n AS avg_distance
    FROM zones LEFT JOIN per_zone USING (location_id)
),
payment AS (
    SELECT payment_type, payment_label, count(*) AS total_trips, sum(total_amount) AS total_revenue,
           sum(total_amount)::DOUBLE / count(*) AS avg_revenue,
           sum(tip_amount)::DOUBLE / count(*) AS avg_tip,
           avg(CASE WHEN total_amount > 0 THEN tip_amount::DOUBLE / total_amount::DOUBLE ELSE 0 END)
               AS avg_tip_ratio
    FROM trips GROUP BY payment_type, payment_label
),
named AS (
    SELECT t.*, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
           pz.service_zone AS pickup_service_zone, dz.borough AS dropoff_borough,
           dz.zone AS dropoff_zone, dz.service_zone AS dropoff_service_zone
    FROM trips t
    JOIN zones pz ON pz.location_id = t.pickup_location_id
    JOIN zones dz ON dz.location_id = t.dropoff_location_id
),
route AS (
    SELECT pickup_location_id, pickup_borough, pickup_zone,
           dropoff_location_id, dropoff_borough, dropoff_zone,
           count(*) AS total_trips, sum(total_amount) AS total_revenue,
           sum(trip_duration_minutes)::DOUBLE / count(*) AS avg_duration_minutes,
           sum(trip_distance)::DOUBLE / count(*) AS avg_distance
    FROM named GROUP BY ALL
),
dropoffs AS (
    SELECT dropoff_location_id AS location_id, count(*) AS dropoff_trips FROM trips GROUP BY ALL
)
"""

_TRIP_MONEY = """trip_duration_minutes::DOUBLE AS trip_duration_minutes,
    passenger_count, trip_distance::DOUBLE AS trip_distance,
    pickup_location_id, dropoff_location_id, payment_type, payment_label,
    fare_amount::DOUBLE AS fare_amount, tip_amount::DOUBLE AS tip_amount,
    total_amount::DOUBLE AS total_amount"""

_TRIP_TIMES = """pickup_datetime, dropoff_datetime, pickup_date, pickup_hour, pickup_day_name,
    is_weekend, time_period"""

_RAW_MEASURES = """passengers AS passenger_count, distance AS trip_distance, fare AS fare_amount,
    tip AS tip_amount, total AS total_amount"""

_DAILY = """SELECT pickup_date, total_trips, total_revenue::DOUBLE AS total_revenue,
    round(avg_revenue, 6) AS avg_revenue, round(avg_fare, 6) AS avg_fare,
    round(avg_tip, 6) AS avg_tip, round(avg_distance, 6) AS avg_distance,
    round(avg_duration_minutes, 6) AS avg_duration_minutes FROM daily"""

_PAYMENT = """SELECT payment_type, payment_label, total_trips, total_revenue::DOUBLE AS total_revenue,
    round(avg_revenue, 6) AS avg_revenue, round(avg_tip, 6) AS avg_tip,
    round(avg_tip_ratio, 6) AS avg_tip_ratio FROM payment"""

_ISSUE_COUNTS = "SELECT error_type, count(*) AS issue_count FROM issues GROUP BY error_type"

_TRIP_KEY = """pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
    passenger_count, trip_distance, total_amount, vendor_id"""


def _money(value: str) -> str:
    return f"'$' || format('{{:,.2f}}', round({value}, 2)::DOUBLE)"


def _top_per_borough(rank: str, method: str, order: str, where: str = "TRUE") -> str:
    return f"""SELECT borough, zone, total_pickup_trips, total_revenue::DOUBLE AS total_revenue, {rank}
    FROM (SELECT *, {method}() OVER (PARTITION BY borough ORDER BY {order}) AS {rank}
          FROM zone WHERE {where}) WHERE {rank} <= 3"""


_TRIPS_THEN_REVENUE = "total_pickup_trips DESC, total_revenue DESC NULLS LAST"

_LOAD_AUDIT = """SELECT split_part(object_name, '.', 1) AS layer_name, object_name, row_count,
        'SUCCESS' AS status FROM (
        SELECT 'bronze.raw_taxi_zones' AS object_name, count(*) AS row_count FROM raw_zones
        UNION ALL SELECT 'bronze.raw_taxi_trips', count(*) FROM raw
        UNION ALL SELECT 'silver.taxi_trips_cleaned', count(*) FROM trips
        UNION ALL SELECT 'silver.data_quality_issues', count(*) FROM issues
        UNION ALL SELECT 'gold.daily_trip_summary', count(*) FROM daily
        UNION ALL SELECT 'gold.hourly_demand_summary', count(*) FROM hourly
        UNION ALL SELECT 'gold.zone_performance_summary', count(*) FROM zone
        UNION ALL SELECT 'gold.payment_behavior_summary', count(*) FROM payment
        UNION ALL SELECT 'gold.route_performance_summary', count(*) FROM route)"""

def _numbered(rows: str) -> str:
    return f"(SELECT row_number() OVER () AS n FROM {rows})"


_FINAL = {
    # raw layer
    "bronze_trips": f"""SELECT vendor_id, p AS tpep_pickup_datetime, d AS tpep_dropoff_datetime,
        NULL::DOUBLE AS ratecode_id, NULL::VARCHAR AS store_and_fwd_flag,
        pu AS pu_location_id, dropoff AS do_location_id, pay AS payment_type,
        NULL::DOUBLE AS extra, NULL::DOUBLE AS mta_tax, NULL::DOUBLE AS tolls_amount,
        NULL::DOUBLE AS improvement_surcharge, NULL::DOUBLE AS congestion_surcharge,
        NULL::DOUBLE AS airport_fee, NULL::DOUBLE AS cbd_congestion_fee,
        'lineitem.parquet' AS source_file, {_RAW_MEASURES} FROM raw""",
    "ingest_trips": f"""SELECT vendor_id, p AS tpep_pickup_datetime, d AS tpep_dropoff_datetime,
        NULL::DOUBLE AS ratecode_id, NULL::VARCHAR AS store_and_fwd_flag,
        pu AS pu_location_id, dropoff AS do_location_id, pay AS payment_type,
        NULL::DOUBLE AS extra, NULL::DOUBLE AS mta_tax, NULL::DOUBLE AS tolls_amount,
        NULL::DOUBLE AS improvement_surcharge, NULL::DOUBLE AS congestion_surcharge,
        NULL::DOUBLE AS airport_fee,
        CASE WHEN vendor_id % 2 = 1 THEN 0.75::DOUBLE END AS cbd_congestion_fee,
        '.parquet' AS source_file, {_RAW_MEASURES} FROM raw""",
    "ingest_zones": """SELECT location_id, borough, zone, nullif(service_zone, '') AS service_zone,
        '.csv' AS source_file FROM raw_zones""",
    "bronze_zones": "SELECT *, 'nation.parquet' AS source_file FROM raw_zones",
    # silver layer
    "silver_zones": "SELECT * FROM zones",
    "silver_issues": "SELECT * FROM issues",
    "silver_valid_trips": f"""SELECT vendor_id, p AS tpep_pickup_datetime,
        d AS tpep_dropoff_datetime, pu AS pu_location_id, dropoff AS do_location_id,
        pay AS payment_type, {_RAW_MEASURES} FROM classified WHERE error_type IS NULL""",
    "silver_trips": f"SELECT vendor_id, {_TRIP_TIMES}, {_TRIP_MONEY} FROM trips",
    # marts and views
    "gold_daily": _DAILY,
    "gold_hourly": """SELECT pickup_date, pickup_hour, time_period, total_trips,
        total_revenue::DOUBLE AS total_revenue,
        round(avg_duration_minutes, 6) AS avg_duration_minutes FROM hourly""",
    "gold_zone": """SELECT location_id, borough, zone, total_pickup_trips,
        total_revenue::DOUBLE AS total_revenue, round(avg_fare, 6) AS avg_fare,
        round(avg_tip, 6) AS avg_tip, round(avg_distance, 6) AS avg_distance FROM zone""",
    "gold_payment": _PAYMENT,
    "gold_route": """SELECT pickup_location_id, pickup_borough, pickup_zone, dropoff_location_id,
        dropoff_borough, dropoff_zone, total_trips, total_revenue::DOUBLE AS total_revenue,
        round(avg_duration_minutes, 6) AS avg_duration_minutes,
        round(avg_distance, 6) AS avg_distance FROM route""",
    "vw_trip_enriched": f"""SELECT {_TRIP_TIMES}, {_TRIP_MONEY}, pickup_borough, pickup_zone,
        pickup_service_zone, dropoff_borough, dropoff_zone, dropoff_service_zone FROM named""",
    "vw_daily": _DAILY,
    "vw_zone_performance": """SELECT location_id, borough, zone, total_pickup_trips,
        coalesce(dropoff_trips, 0) AS total_dropoff_trips, total_revenue::DOUBLE AS total_revenue,
        round(avg_fare, 6) AS avg_fare, round(avg_tip, 6) AS avg_tip,
        round(avg_distance, 6) AS avg_distance FROM zone LEFT JOIN dropoffs USING (location_id)""",
    # questions
    "q01_total_trips": "SELECT count(*) AS jumlah_total_trip_valid FROM trips",
    "q02_revenue_text": f"""SELECT {_money('sum(total_amount)')} AS total_revenue,
        {_money('sum(total_amount)::DOUBLE / count(*)')} AS avg_revenue,
        {_money('sum(fare_amount)::DOUBLE / count(*)')} AS avg_fare,
        {_money('sum(tip_amount)::DOUBLE / count(*)')} AS avg_tip FROM trips""",
    "q02_revenue_raw": """SELECT sum(total_amount)::DOUBLE AS total_revenue,
        round(sum(total_amount)::DOUBLE / count(*), 6) AS avg_revenue,
        round(sum(fare_amount)::DOUBLE / count(*), 6) AS avg_fare,
        round(sum(tip_amount)::DOUBLE / count(*), 6) AS avg_tip FROM trips""",
    "q03_peak_hours": """SELECT pickup_date, pickup_hour, total_trips FROM hourly
        ORDER BY total_trips DESC, pickup_date, pickup_hour LIMIT 10""",
    "q04_weekday_weekend": """SELECT CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS day_type,
        count(*) AS total_trips, sum(total_amount)::DOUBLE AS total_revenue FROM trips GROUP BY day_type""",
    "q05_payment": "SELECT payment_label, total_trips, total_revenue::DOUBLE AS total_revenue FROM payment",
    "q06_top_zones_trips": """SELECT borough, zone, total_pickup_trips FROM zone
        ORDER BY total_pickup_trips DESC, location_id LIMIT 10""",
    "q07_top_zones_revenue": """SELECT borough, zone, total_revenue::DOUBLE AS total_revenue FROM zone
        ORDER BY zone.total_revenue DESC NULLS LAST, location_id LIMIT 10""",
    "q07_top_zones_text": f"""SELECT borough, zone, {_money('total_revenue')} AS total_revenue
        FROM (SELECT * FROM zone ORDER BY total_revenue DESC NULLS LAST, location_id LIMIT 10)""",
    "q08_top_routes": """SELECT pickup_borough, pickup_zone, dropoff_borough, dropoff_zone, total_trips
        FROM route ORDER BY total_trips DESC, pickup_location_id, dropoff_location_id LIMIT 10""",
    "q09_time_period": """SELECT time_period, count(*) AS total_trips,
        sum(total_amount)::DOUBLE AS total_revenue,
        round(sum(trip_duration_minutes)::DOUBLE / count(*), 6) AS avg_duration_minutes
        FROM trips GROUP BY time_period""",
    "q10_issue_counts": _ISSUE_COUNTS,
    "q11_hourly_anomalies": """SELECT pickup_date, pickup_hour, total_trips FROM hourly
        WHERE total_trips > (SELECT avg(total_trips) + 2 * stddev_pop(total_trips) FROM hourly)
           OR total_trips < (SELECT greatest(avg(total_trips) - 2 * stddev_pop(total_trips), 0) FROM hourly)""",
    "q13_top_zone_revenue_cte": """SELECT borough, zone, total_revenue::DOUBLE AS total_revenue
        FROM (SELECT * FROM zone ORDER BY total_revenue DESC NULLS LAST, location_id LIMIT 10)""",
    "q14_busy_low_tip": """SELECT borough, zone, total_pickup_trips, round(avg_tip, 6) AS avg_tip,
        round(pickup_percentile, 6) AS pickup_percentile, round(tip_percentile, 6) AS tip_percentile
        FROM (SELECT *, percent_rank() OVER (ORDER BY total_pickup_trips) AS pickup_percentile,
                     percent_rank() OVER (ORDER BY avg_tip) AS tip_percentile
              FROM zone WHERE total_pickup_trips > 0)
        WHERE pickup_percentile >= 0.75 AND tip_percentile <= 0.25""",
    "q15_daily_vs_avg": """SELECT pickup_date, total_revenue::DOUBLE AS total_revenue,
        round(m, 6) AS avg_daily_revenue, round(total_revenue::DOUBLE - m, 6) AS revenue_vs_average
        FROM daily, (SELECT sum(total_revenue)::DOUBLE / count(*) AS m FROM daily)""",
    "q16_long_trips": f"""SELECT pickup_datetime, pickup_borough, pickup_zone,
        trip_duration_minutes::DOUBLE AS trip_duration_minutes, round(m, 6) AS avg_zone_duration
        FROM (SELECT *, total_minutes::DOUBLE / n AS m
              FROM (SELECT *, sum(trip_duration_minutes) OVER z AS total_minutes, count(*) OVER z AS n
                    FROM named WINDOW z AS (PARTITION BY pickup_location_id))
              WHERE trip_duration_minutes::DECIMAL(18, 2) * n::DECIMAL(18, 0) > total_minutes
              ORDER BY trip_duration_minutes DESC, {_TRIP_KEY} LIMIT 100)""",
    "q17_small_boroughs": """SELECT pickup_borough, r::DOUBLE AS total_revenue,
        round(r::DOUBLE / all_r::DOUBLE, 6) AS revenue_share
        FROM (SELECT pickup_borough, sum(total_amount)::DECIMAL(24, 2) AS r FROM named GROUP BY pickup_borough),
             (SELECT sum(total_amount)::DECIMAL(24, 2) AS all_r FROM named)
        WHERE r < all_r * 0.05::DECIMAL(2, 2)""",
    "q18_zone_rank": """SELECT borough, zone, total_revenue::DOUBLE AS total_revenue,
        rank() OVER (ORDER BY zone.total_revenue DESC NULLS LAST) AS revenue_rank FROM zone""",
    "q19_top3_revenue": _top_per_borough(
        "borough_rank", "row_number", "total_revenue DESC NULLS LAST, location_id"
    ),
    "q20_running_revenue": """SELECT pickup_date, total_revenue::DOUBLE AS total_revenue,
        (sum(daily.total_revenue) OVER (ORDER BY pickup_date))::DOUBLE AS running_total_revenue FROM daily""",
    "q21_moving_avg_7": """SELECT pickup_date, total_trips, round(avg(total_trips) OVER (
        ORDER BY pickup_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg_trip_7d
        FROM daily""",
    "q22_day_delta": """SELECT pickup_date, total_revenue::DOUBLE AS total_revenue,
        (lag(daily.total_revenue) OVER (ORDER BY pickup_date))::DOUBLE AS previous_day_revenue,
        (daily.total_revenue - lag(daily.total_revenue) OVER (ORDER BY pickup_date))::DOUBLE AS revenue_delta
        FROM daily""",
    "q23_top3_trips": _top_per_borough(
        "zone_rank", "row_number", f"{_TRIPS_THEN_REVENUE}, location_id", "total_pickup_trips > 0"
    ),
    "q23_top3_trips_rank": _top_per_borough(
        "zone_rank", "rank", _TRIPS_THEN_REVENUE, "total_pickup_trips > 0"
    ),
    "q23_top3_trips_dense_rank": _top_per_borough(
        "zone_rank", "dense_rank", _TRIPS_THEN_REVENUE, "total_pickup_trips > 0"
    ),
    # exports
    "export_daily_summary": _DAILY,
    "export_top_pickup_zones": """SELECT borough, zone, total_pickup_trips,
        total_revenue::DOUBLE AS total_revenue FROM zone
        ORDER BY zone.total_revenue DESC NULLS LAST, location_id LIMIT 20""",
    "export_payment_behavior": _PAYMENT,
    "export_data_quality_issues": _ISSUE_COUNTS,
    # row counts
    "load_audit": f"SELECT *, 2 AS runs FROM ({_LOAD_AUDIT})",
    "row_conservation": """SELECT *, CASE WHEN raw_rows = kept_rows + rejected_rows + dropped_rows
        THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM (
        SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM trips) AS kept_rows,
               (SELECT count(*) FROM issues) AS rejected_rows,
               (SELECT count(*) FROM numbered WHERE copy > 1 AND vendor_id IS NOT NULL) AS dropped_rows)""",
    # constraint checks
    "k1_repeated_raw_zone_ids": """SELECT location_id, count(*) AS copies FROM raw_zones
        GROUP BY location_id HAVING count(*) > 1 OR location_id IS NULL""",
    "k1_primary_keys": " UNION ALL ".join(
        f"""SELECT '{name}' AS object_name, count(*) FILTER (complete) AS distinct_keys,
            count(*) FILTER (copies > 1 OR NOT complete) AS violations
            FROM (SELECT {' AND '.join(f'{key} IS NOT NULL' for key in keys.split(', '))} AS complete,
                         count(*) AS copies FROM {rows} GROUP BY {keys})"""
        for name, rows, keys in (
            ("silver.taxi_zones", "zones", "location_id"),
            # Spark numbers the stored rows in its own way: as many keys as rows are due.
            ("silver.taxi_trips_cleaned", _numbered("trips"), "n"),
            ("silver.data_quality_issues", _numbered("issues"), "n"),
            ("gold.daily_trip_summary", "daily", "pickup_date"),
            ("gold.hourly_demand_summary", "hourly", "pickup_date, pickup_hour"),
            ("gold.zone_performance_summary", "zone", "location_id"),
            ("gold.payment_behavior_summary", "payment", "payment_type"),
            ("gold.route_performance_summary", "route", "pickup_location_id, dropoff_location_id"),
        )
    ),
    "k2_foreign_keys": """SELECT 'pickup_location_id' AS check_name, count(*) AS violations FROM trips
        WHERE pickup_location_id NOT IN (SELECT location_id FROM zones)
        UNION ALL SELECT 'dropoff_location_id', count(*) FROM trips
        WHERE dropoff_location_id NOT IN (SELECT location_id FROM zones)""",
    "k2_raw_orphans": """SELECT trip_end, location_id, count(*) AS orphans FROM (
            SELECT 'pu_location_id' AS trip_end, pu AS location_id FROM raw
            UNION ALL SELECT 'do_location_id', dropoff FROM raw)
        WHERE location_id NOT IN (SELECT location_id FROM zones) GROUP BY ALL""",
    "k3_not_null": """UNPIVOT (SELECT
        count(*) FILTER (pickup_datetime IS NULL) AS pickup_datetime,
        count(*) FILTER (dropoff_datetime IS NULL) AS dropoff_datetime,
        count(*) FILTER (pickup_date IS NULL) AS pickup_date,
        count(*) FILTER (pickup_hour IS NULL) AS pickup_hour,
        count(*) FILTER (pickup_day_name IS NULL) AS pickup_day_name,
        count(*) FILTER (is_weekend IS NULL) AS is_weekend,
        count(*) FILTER (time_period IS NULL) AS time_period,
        count(*) FILTER (trip_duration_minutes IS NULL) AS trip_duration_minutes,
        count(*) FILTER (passenger_count IS NULL) AS passenger_count,
        count(*) FILTER (trip_distance IS NULL) AS trip_distance,
        count(*) FILTER (pickup_location_id IS NULL) AS pickup_location_id,
        count(*) FILTER (dropoff_location_id IS NULL) AS dropoff_location_id,
        count(*) FILTER (payment_type IS NULL) AS payment_type,
        count(*) FILTER (payment_label IS NULL) AS payment_label,
        count(*) FILTER (fare_amount IS NULL) AS fare_amount,
        count(*) FILTER (tip_amount IS NULL) AS tip_amount,
        count(*) FILTER (total_amount IS NULL) AS total_amount
        FROM trips) ON COLUMNS(*) INTO NAME check_name VALUE violations""",
    "k3_raw_nulls": """UNPIVOT (SELECT
        count(*) FILTER (vendor_id IS NULL) AS vendor_id,
        count(*) FILTER (p IS NULL) AS tpep_pickup_datetime,
        count(*) FILTER (d IS NULL) AS tpep_dropoff_datetime,
        count(*) FILTER (passengers IS NULL) AS passenger_count,
        count(*) FILTER (distance IS NULL) AS trip_distance,
        count(*) AS ratecode_id,
        count(*) AS store_and_fwd_flag,
        count(*) FILTER (pu IS NULL) AS pu_location_id,
        count(*) FILTER (dropoff IS NULL) AS do_location_id,
        count(*) FILTER (pay IS NULL) AS payment_type,
        count(*) FILTER (fare IS NULL) AS fare_amount,
        count(*) AS extra,
        count(*) AS mta_tax,
        count(*) FILTER (tip IS NULL) AS tip_amount,
        count(*) AS tolls_amount,
        count(*) AS improvement_surcharge,
        count(*) FILTER (total IS NULL) AS total_amount,
        count(*) AS congestion_surcharge,
        count(*) AS airport_fee,
        count(*) AS cbd_congestion_fee
        FROM raw) ON COLUMNS(*) INTO NAME check_name VALUE violations""",
    "k4_ranges": """UNPIVOT (SELECT
        count(*) FILTER (pickup_hour NOT BETWEEN 0 AND 23) AS pickup_hour,
        count(*) FILTER (trip_duration_minutes <= 0) AS trip_duration_minutes,
        count(*) FILTER (passenger_count <= 0) AS passenger_count,
        count(*) FILTER (trip_distance <= 0) AS trip_distance,
        count(*) FILTER (fare_amount < 0) AS fare_amount,
        count(*) FILTER (tip_amount < 0) AS tip_amount,
        count(*) FILTER (total_amount < 0) AS total_amount
        FROM trips) ON COLUMNS(*) INTO NAME check_name VALUE violations""",
    "k4_raw_ranges": """UNPIVOT (SELECT
        count(*) FILTER (d <= p) AS duration,
        count(*) FILTER (passengers <= 0) AS passenger_count,
        count(*) FILTER (distance <= 0) AS trip_distance,
        count(*) FILTER (fare < 0) AS fare_amount,
        count(*) FILTER (tip < 0) AS tip_amount,
        count(*) FILTER (total < 0) AS total_amount
        FROM raw) ON COLUMNS(*) INTO NAME check_name VALUE violations""",
    "k5_natural_key": """SELECT count(*) AS repeated_keys FROM (
        SELECT 1 FROM trips WHERE vendor_id IS NOT NULL GROUP BY vendor_id, pickup_datetime,
        dropoff_datetime, pickup_location_id, dropoff_location_id, passenger_count, trip_distance,
        total_amount HAVING count(*) > 1)""",
    "k5_repeated_valid_trips": """SELECT vendor_id, pickup_datetime, dropoff_datetime,
        pickup_location_id, dropoff_location_id, passenger_count,
        trip_distance::DOUBLE AS trip_distance, total_amount::DOUBLE AS total_amount,
        count(*) AS copies FROM valid WHERE vendor_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "k6_status_values": f"""SELECT 'audit.load_audit' AS object_name, count(*) AS log_rows,
        count(*) FILTER (status NOT IN ('SUCCESS', 'FAILED')) AS violations FROM ({_LOAD_AUDIT})
        UNION ALL SELECT 'audit.pipeline_run', count(*), 0 FROM (VALUES ('STARTED'), ('SUCCESS'))""",
}


def oracle_sql() -> dict[str, str]:
    """Statement per query name."""
    shared = _RAW + _SILVER + _GOLD
    statements = {}
    for name, final in _FINAL.items():
        if final.startswith("UNPIVOT"):
            final = f"SELECT check_name, violations::BIGINT AS violations FROM ({final})"
        statements[name] = f"{shared} {final}"
    return statements
