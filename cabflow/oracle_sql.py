"""DuckDB twins of the registered queries (the correctness oracle).

The oracle sees only the base tables, so every statement inlines the trip
fixture, the zone lookup, the enrichment and the routing as CTEs. These are
written independently of the Spark code, in DuckDB's own dialect.
"""

from __future__ import annotations

from cabflow import schema as S
from cabflow.sources.period import Period

RAW_TRIPS = """
raw_trips AS (
  SELECT
    CAST(l_suppkey % 3 + 1 AS BIGINT) AS VendorID,
    l_shipdate + to_seconds((l_orderkey * 37 + l_linenumber * 6113) % 86400) AS tpep_pickup_datetime,
    CASE WHEN l_partkey % 1009 = 0 THEN NULL
         ELSE l_shipdate + to_seconds(
              (l_orderkey * 37 + l_linenumber * 6113) % 86400
              + (l_partkey * 13 + CAST(l_quantity AS BIGINT) * 61) % 3600 - 30
              + CASE WHEN l_orderkey % 997 = 0 THEN 90000 ELSE 0 END) END AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS BIGINT) % 6 + 1 END AS passenger_count,
    CASE WHEN l_partkey % 499 = 0 THEN l_quantity * 10 ELSE l_quantity / 4 END AS trip_distance,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey % 6 + 1 END AS RatecodeID,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 50 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    l_partkey % 27 + 1 AS PULocationID,
    l_orderkey % 27 + 1 AS DOLocationID,
    l_orderkey % 5 AS payment_type,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 ELSE 1 END * l_extendedprice / 110 AS fare_amount,
    CASE WHEN l_linenumber = 2 THEN 1.0e0 ELSE 0.0e0 END AS extra,
    0.5e0 AS mta_tax,
    l_discount * l_extendedprice / 110 AS tip_amount,
    CASE WHEN l_partkey % 10 = 0 THEN 6.94e0 ELSE 0.0e0 END AS tolls_amount,
    1.0e0 AS improvement_surcharge,
    CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 ELSE 1 END
      * l_extendedprice / 110 * (1 + l_tax) AS total_amount,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 2.5e0 END AS congestion_surcharge,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 0.0e0 END AS Airport_fee,
    0.75e0 AS cbd_congestion_fee
  FROM lineitem
)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey + 1 AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
         CASE WHEN n_nationkey % 3 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

ENRICHED = """
trips AS (
  SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
         tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance,
         RatecodeID AS rate_code_id, store_and_fwd_flag, PULocationID AS pickup_location_id,
         DOLocationID AS dropoff_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
         tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
         Airport_fee AS airport_fee, cbd_congestion_fee
  FROM raw_trips
),
metrics AS (
  SELECT *,
    date_diff('second', pickup_datetime, dropoff_datetime) / 60.0e0 AS trip_duration_minutes,
    CAST(pickup_datetime AS DATE) AS pickup_date,
    CAST(year(pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(month(pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(day(pickup_datetime) AS INTEGER) AS pickup_day,
    CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    dayname(pickup_datetime) AS pickup_weekday,
    dayofweek(pickup_datetime) IN (0, 6) AS is_weekend
  FROM trips
),
flags AS (
  SELECT *,
    (pickup_hour BETWEEN 7 AND 9) OR (pickup_hour BETWEEN 16 AND 19) AS is_peak_hour,
    CASE WHEN trip_duration_minutes > 0 THEN trip_distance / (trip_duration_minutes / 60.0e0) END AS average_speed_mph,
    (fare_amount < 0) OR (total_amount < 0) AS is_refund_or_reversal,
    (trip_duration_minutes <= 0) OR (trip_duration_minutes > 1440)
      OR (trip_distance > 100) OR (total_amount > 1000) AS is_anomalous_trip
  FROM metrics
),
enriched AS (
  SELECT f.*,
    pz.Borough AS pickup_borough, pz.Zone AS pickup_zone, pz.service_zone AS pickup_service_zone,
    dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone, dz.service_zone AS dropoff_service_zone
  FROM flags f
  LEFT JOIN zones pz ON f.pickup_location_id = pz.LocationID
  LEFT JOIN zones dz ON f.dropoff_location_id = dz.LocationID
)"""


def routed(period: Period) -> str:
    return f"""
in_period AS (
  SELECT * FROM enriched
  WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '{period.start}' AND DATE '{period.end}'
),
curated AS (SELECT * FROM in_period WHERE NOT coalesce(is_anomalous_trip, true)),
rejected AS (SELECT * FROM in_period WHERE coalesce(is_anomalous_trip, true)),
stg_trips AS (SELECT {", ".join(c for c in S.STG_COLUMNS if c != "processing_timestamp")} FROM curated)"""


def with_raw(body: str) -> str:
    return f"WITH {RAW_TRIPS}\n{body}"


def with_zones(body: str) -> str:
    return f"WITH {ZONES}\n{body}"


def with_enriched(body: str) -> str:
    return f"WITH {RAW_TRIPS},{ZONES},{ENRICHED}\n{body}"


def with_routed(period: Period, body: str) -> str:
    return f"WITH {RAW_TRIPS},{ZONES},{ENRICHED},{routed(period)}\n{body}"
