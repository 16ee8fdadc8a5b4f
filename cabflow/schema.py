"""Column contracts, rename map and rule thresholds.

Everything in this module is a fixed value: the names, orders and limits
must stay exactly as listed for results to agree with the job this library
replaces.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw trip contract (ordered, 20 columns) -----------------
RAW_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "Airport_fee",
    "cbd_congestion_fee",
]

# --- fixed values: columns the profiler requires (11) ----------------------
PROFILE_REQUIRED_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
]

# --- fixed values: raw name -> standard name --------------------------------
RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "Airport_fee": "airport_fee",
}

# --- fixed values: zone lookup columns --------------------------------------
ZONE_COLUMNS = ["LocationID", "Borough", "Zone", "service_zone"]

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# --- fixed values: rule thresholds -----------------------------------------
MAX_DURATION_MINUTES = 1440          # 24 hours
MAX_DISTANCE_MILES = 100
MAX_TOTAL_AMOUNT = 1000
PEAK_HOUR_RANGES = [(7, 9), (16, 19)]   # inclusive
WEEKEND_DAYS = [1, 7]                # Spark dayofweek: Sunday=1, Saturday=7
MIN_LOCATION_ID = 1
MAX_LOCATION_ID = 265
DISTANCE_MOSTLY = 0.999
MIN_RAW_YEAR = 2009                  # first month the raw feed exists
PERIOD_FORMAT = "%d/%m/%Y"           # dd/MM/yyyy
SAMPLE_SIZE = 10_000

# --- fixed values: staging projection (27 columns, in order) ---------------
STG_COLUMNS = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "pickup_borough",
    "pickup_zone",
    "dropoff_borough",
    "dropoff_zone",
    "trip_duration_minutes",
    "average_speed_mph",
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_weekday",
    "is_weekend",
    "is_peak_hour",
    "processing_timestamp",
]

# --- fixed values: the 11-column enriched preview ---------------------------
PREVIEW_COLUMNS = [
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_borough",
    "pickup_zone",
    "dropoff_borough",
    "dropoff_zone",
    "trip_distance",
    "trip_duration_minutes",
    "average_speed_mph",
    "total_amount",
    "is_anomalous_trip",
]

# Partition keys of the curated and rejected tables.
DAY_PARTITION = ["pickup_year", "pickup_month", "pickup_day"]
# Partition keys of the raw landing layout (year=YYYY/month=MM).
RAW_PARTITION = ["year", "month"]
