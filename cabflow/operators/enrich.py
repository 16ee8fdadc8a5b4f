"""Standardize, derive and zone-enrich trips.

All steps are ``DataFrame -> DataFrame`` so they chain with ``.transform``.
The enrichment is row-local except the two zone joins, whose lookup side is
tiny and broadcast behind a size check, so the trip side never shuffles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow import schema as S
from cabflow.functions import trip_columns as C
from cabflow.sources.raw import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    approx_row_bytes,
    lookup_side,
    require_columns,
)


def standardize(trips: DataFrame) -> DataFrame:
    """Rename raw columns to snake_case; names that are absent are ignored."""
    present = {old: new for old, new in S.RENAMES.items() if old in trips.columns}
    return trips.withColumnsRenamed(present)


def coerce_datetimes(trips: DataFrame) -> DataFrame:
    """Pickup/dropoff as timestamp without zone; bad values become NULL."""
    return trips.withColumns(
        {c: C.coerce_timestamp(c) for c in ("pickup_datetime", "dropoff_datetime")}
    )


def add_trip_metrics(trips: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Duration, calendar parts, flags, speed and the run timestamp.

    ``run_ts`` is one literal for the whole run so curated and rejected rows
    carry the same processing time.
    """
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    pickup = F.col("pickup_datetime")
    step1 = trips.withColumns(
        {
            "trip_duration_minutes": C.duration_minutes(),
            "pickup_date": F.to_date(pickup),
            "pickup_year": F.year(pickup),
            "pickup_month": F.month(pickup),
            "pickup_day": F.dayofmonth(pickup),
            "pickup_hour": F.hour(pickup),
            "pickup_weekday": F.date_format(pickup, "EEEE"),
            "is_weekend": C.is_weekend(),
        }
    )
    return step1.withColumns(
        {
            "is_peak_hour": C.is_peak_hour(),
            "average_speed_mph": C.average_speed_mph(),
            "is_refund_or_reversal": C.is_refund_or_reversal(),
            "is_anomalous_trip": C.is_anomalous_trip(),
            "processing_timestamp": F.lit(run_ts).cast("timestamp"),
        }
    )


def zone_side(zones: DataFrame, role: str) -> DataFrame:
    """Zone lookup renamed for one join role: ``pickup`` or ``dropoff``."""
    return zones.select(
        F.col("LocationID").cast("bigint").alias(f"{role}_location_id"),
        F.col("Borough").alias(f"{role}_borough"),
        F.col("Zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def duplicate_zone_keys(zones: DataFrame) -> DataFrame:
    """Lookup keys that occur more than once (must be empty for a many-to-one join)."""
    return (
        zones.groupBy("LocationID")
        .agg(F.count(F.lit(1)).alias("key_count"))
        .filter(F.col("key_count") > 1)
    )


def assert_unique_zone_keys(zones: DataFrame) -> None:
    dup = duplicate_zone_keys(zones).limit(5).collect()
    if dup:
        keys = [r["LocationID"] for r in dup]
        raise ValueError(f"zone lookup key is not unique, e.g. LocationID {keys}")


def probe_lookup(zones: DataFrame) -> tuple[bool, bool]:
    """One aggregation over the lookup -> (fits broadcast, key unique).

    A lookup is small by nature (one row per zone); if one ever is not, this
    pass costs one scan of it, and the join falls back to a shuffle join.
    """
    r = zones.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(approx_row_bytes(zones)).alias("b"),
        F.count_distinct("LocationID").alias("keys"),
        F.count("LocationID").alias("non_null"),
    ).first()
    small = r["n"] <= MAX_BROADCAST_ROWS and (r["b"] or 0) <= MAX_BROADCAST_BYTES
    unique = r["keys"] == r["non_null"]
    return small, unique


def join_zones(trips: DataFrame, zones: DataFrame, validate: bool = True) -> DataFrame:
    """Left-join pickup and dropoff zones; unmatched ids keep NULL zone columns.

    The lookup is checked once (unique key, bounded size) and then used for
    both roles: one broadcast per role, no shuffle of the trip side. A lookup
    beyond the bound is joined by the planner's shuffle strategies instead.
    """
    require_columns(zones.columns, S.ZONE_COLUMNS, what="zone lookup")
    small, unique = probe_lookup(zones)
    if validate and not unique:
        assert_unique_zone_keys(zones)
    pickup = lookup_side(zone_side(zones, "pickup"), small)
    dropoff = lookup_side(zone_side(zones, "dropoff"), small)
    return trips.join(pickup, "pickup_location_id", "left").join(dropoff, "dropoff_location_id", "left")


def enrich(
    raw_trips: DataFrame,
    zones: DataFrame,
    run_ts: dt.datetime | None = None,
    validate: bool = True,
) -> DataFrame:
    """Raw trips -> enriched trips (39 columns plus any partition columns)."""
    trips = raw_trips.transform(standardize).transform(coerce_datetimes)
    return join_zones(add_trip_metrics(trips, run_ts), zones, validate=validate)
