import datetime as dt

import pytest
from pyspark.sql import functions as F

from cabflow import schema as S
from cabflow.operators import enrich as E

TS = dt.datetime


def raw_frame(spark, rows):
    """Raw trips with the 20 contract columns; rows give a few, rest default."""
    base = {
        "VendorID": 1, "tpep_pickup_datetime": TS(2025, 1, 15, 8, 0, 0),
        "tpep_dropoff_datetime": TS(2025, 1, 15, 8, 30, 0), "passenger_count": 1,
        "trip_distance": 5.0, "RatecodeID": 1, "store_and_fwd_flag": "N", "PULocationID": 1,
        "DOLocationID": 2, "payment_type": 1, "fare_amount": 10.0, "extra": 0.0, "mta_tax": 0.5,
        "tip_amount": 1.0, "tolls_amount": 0.0, "improvement_surcharge": 1.0, "total_amount": 12.5,
        "congestion_surcharge": 2.5, "Airport_fee": 0.0, "cbd_congestion_fee": 0.75,
    }
    ddl = (
        "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
        "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, extra double, "
        "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
        "total_amount double, congestion_surcharge double, Airport_fee double, cbd_congestion_fee double"
    )
    data = [tuple({**base, **r}[c] for c in S.RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(data, ddl)


def zones_frame(spark, rows=None):
    rows = rows or [(1, "Manhattan", "Alphabet City", "Yellow Zone"), (2, "Queens", "Astoria", "Boro Zone")]
    return spark.createDataFrame(rows, S.ZONE_SCHEMA)


def enrich_rows(spark, rows, zones=None):
    out = E.enrich(raw_frame(spark, rows), zones if zones is not None else zones_frame(spark))
    return out.collect()


def test_rename_and_column_count(spark):
    df = E.enrich(raw_frame(spark, [{}]), zones_frame(spark))
    for old, new in S.RENAMES.items():
        assert new in df.columns and old not in df.columns
    assert len(df.columns) == 39


def test_rename_ignores_absent_columns(spark):
    df = raw_frame(spark, [{}]).drop("Airport_fee")
    assert "airport_fee" not in E.standardize(df).columns


@pytest.mark.parametrize(
    "minutes,anomalous",
    [(-1, True), (0, True), (1, False), (1440, False), (1441, True)],
)
def test_duration_thresholds(spark, minutes, anomalous):
    p = TS(2025, 1, 15, 8, 0, 0)
    [r] = enrich_rows(spark, [{"tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + dt.timedelta(minutes=minutes)}])
    assert r["trip_duration_minutes"] == minutes
    assert r["is_anomalous_trip"] is anomalous
    assert (r["average_speed_mph"] is None) == (minutes <= 0)


def test_duration_whole_seconds(spark):
    p = TS(2025, 1, 15, 8, 0, 0, 900_000)
    [r] = enrich_rows(spark, [{"tpep_pickup_datetime": p, "tpep_dropoff_datetime": TS(2025, 1, 15, 8, 1, 0, 100_000)}])
    assert r["trip_duration_minutes"] == 1.0  # seconds are floored before the difference


@pytest.mark.parametrize("distance,anomalous", [(100.0, False), (100.01, True)])
def test_distance_threshold(spark, distance, anomalous):
    [r] = enrich_rows(spark, [{"trip_distance": distance}])
    assert r["is_anomalous_trip"] is anomalous


@pytest.mark.parametrize("total,anomalous", [(1000.0, False), (1000.01, True)])
def test_total_threshold(spark, total, anomalous):
    [r] = enrich_rows(spark, [{"total_amount": total}])
    assert r["is_anomalous_trip"] is anomalous


@pytest.mark.parametrize("hour,peak", [(6, False), (7, True), (9, True), (10, False), (15, False), (16, True), (19, True), (20, False)])
def test_peak_hours(spark, hour, peak):
    p = TS(2025, 1, 15, hour, 30, 0)
    [r] = enrich_rows(spark, [{"tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + dt.timedelta(minutes=10)}])
    assert r["pickup_hour"] == hour and r["is_peak_hour"] is peak


@pytest.mark.parametrize(
    "day,weekday,weekend",
    [(TS(2025, 1, 4), "Saturday", True), (TS(2025, 1, 5), "Sunday", True), (TS(2025, 1, 6), "Monday", False)],
)
def test_weekday_and_weekend(spark, day, weekday, weekend):
    [r] = enrich_rows(spark, [{"tpep_pickup_datetime": day, "tpep_dropoff_datetime": day + dt.timedelta(minutes=5)}])
    assert r["pickup_weekday"] == weekday and r["is_weekend"] is weekend


def test_calendar_parts_year_boundary(spark):
    p = TS(2024, 12, 31, 23, 59, 59)
    [r] = enrich_rows(spark, [{"tpep_pickup_datetime": p, "tpep_dropoff_datetime": TS(2025, 1, 1, 0, 10, 0)}])
    assert (r["pickup_year"], r["pickup_month"], r["pickup_day"], r["pickup_hour"]) == (2024, 12, 31, 23)
    assert r["pickup_date"] == dt.date(2024, 12, 31)


def test_refund_flag_does_not_reject(spark):
    [r] = enrich_rows(spark, [{"fare_amount": -5.0, "total_amount": -6.0}])
    assert r["is_refund_or_reversal"] is True and r["is_anomalous_trip"] is False


def test_null_dropoff_gives_null_flag(spark):
    [r] = enrich_rows(spark, [{"tpep_dropoff_datetime": None}])
    assert r["trip_duration_minutes"] is None and r["is_anomalous_trip"] is None


def test_unparsable_timestamp_becomes_null(spark):
    df = raw_frame(spark, [{}]).withColumn("tpep_pickup_datetime", F.lit("not a time"))
    [r] = E.enrich(df, zones_frame(spark)).collect()
    assert r["pickup_datetime"] is None


def test_unmatched_zone_keeps_row(spark):
    rows = enrich_rows(spark, [{"PULocationID": 1, "DOLocationID": 264}])
    assert len(rows) == 1
    assert rows[0]["pickup_zone"] == "Alphabet City" and rows[0]["dropoff_zone"] is None


def test_duplicate_zone_key_raises(spark):
    zones = zones_frame(spark, [(1, "A", "x", "s"), (1, "B", "y", "s")])
    with pytest.raises(ValueError, match="not unique"):
        E.enrich(raw_frame(spark, [{}]), zones)


def test_missing_zone_column_raises(spark):
    zones = zones_frame(spark).drop("Borough")
    with pytest.raises(ValueError, match="Borough"):
        E.enrich(raw_frame(spark, [{}]), zones)


def test_processing_timestamp_single_literal(spark):
    run = dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc)
    df = E.enrich(raw_frame(spark, [{}, {"VendorID": 2}]), zones_frame(spark), run_ts=run)
    assert df.select("processing_timestamp").distinct().count() == 1
