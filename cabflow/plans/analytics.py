"""Ad-hoc and validation queries over the curated / rejected tables.

Group-bys run as partial + final hash aggregates (map-side combine), so a
hot key costs one row per map task, not one row per trip. Top-N reports use
``orderBy(...).limit(n)``, which plans as ``TakeOrderedAndProject``: each task
keeps its own best ``n`` and only those reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow import schema as S


def _count():
    return F.count(F.lit(1))


def total_trips(curated: DataFrame) -> DataFrame:
    return curated.agg(_count().alias("total_trips"))


def trips_per_borough(curated: DataFrame) -> DataFrame:
    return curated.groupBy("pickup_borough").agg(_count().alias("trip_count")).orderBy(
        F.desc("trip_count"), F.asc_nulls_first("pickup_borough")
    )


def trips_per_hour(curated: DataFrame) -> DataFrame:
    return curated.groupBy("pickup_hour").agg(_count().alias("trip_count")).orderBy("pickup_hour")


def avg_total_per_borough(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("pickup_borough")
        .agg(F.round(F.avg("total_amount"), 2).alias("avg_total_amount"))
        .orderBy(F.desc("avg_total_amount"), F.asc_nulls_first("pickup_borough"))
    )


def avg_distance_per_borough(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("pickup_borough")
        .agg(F.round(F.avg("trip_distance"), 2).alias("avg_trip_distance"))
        .orderBy(F.desc("avg_trip_distance"), F.asc_nulls_first("pickup_borough"))
    )


def trips_by_peak_hour(curated: DataFrame) -> DataFrame:
    return curated.groupBy("is_peak_hour").agg(_count().alias("trip_count"))


def top_zones(curated: DataFrame, role: str = "pickup", n: int = 10) -> DataFrame:
    """Top-``n`` zones by trip count; ties broken by zone name (NULL first)."""
    zone = f"{role}_zone"
    return (
        curated.groupBy(zone)
        .agg(_count().alias("trip_count"))
        .orderBy(F.desc("trip_count"), F.asc_nulls_first(zone))
        .limit(n)
    )


def top_rejected_by_amount(rejected: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` rejected trips with the largest total, five columns.

    Ties on the total are broken by the remaining output columns so the
    result is a deterministic set.
    """
    return (
        rejected.select(
            "trip_distance", "trip_duration_minutes", "total_amount", "pickup_zone", "dropoff_zone"
        )
        .orderBy(
            F.desc_nulls_last("total_amount"),
            F.desc_nulls_last("trip_distance"),
            F.desc_nulls_last("trip_duration_minutes"),
            F.asc_nulls_first("pickup_zone"),
            F.asc_nulls_first("dropoff_zone"),
        )
        .limit(n)
    )


def curated_date_range(curated: DataFrame) -> DataFrame:
    return curated.agg(
        F.min("pickup_datetime").alias("min_pickup_date"),
        F.max("pickup_datetime").alias("max_pickup_date"),
        _count().alias("trip_count"),
    )


def monthly_trip_counts(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy("pickup_year", "pickup_month")
        .agg(_count().alias("trip_count"))
        .orderBy("pickup_year", "pickup_month")
    )


def rejected_count(rejected: DataFrame) -> DataFrame:
    return rejected.agg(_count().alias("rejected_count"))


def unmatched_zone_counts(enriched: DataFrame) -> DataFrame:
    """Trips whose pickup / dropoff id found no zone (one pass for both)."""
    return enriched.agg(
        F.count_if(F.col("pickup_zone").isNull()).alias("missing_pickup_zones"),
        F.count_if(F.col("dropoff_zone").isNull()).alias("missing_dropoff_zones"),
    )


def run_summary(enriched: DataFrame) -> DataFrame:
    """Rows, final column count and anomalous rows of one transformation run."""
    return enriched.agg(
        _count().alias("transformed_rows"),
        F.lit(len(enriched.columns)).cast("bigint").alias("final_column_count"),
        F.count_if(F.col("is_anomalous_trip")).alias("anomalous_rows"),
    )


def enriched_preview(enriched: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows of the 11 preview columns in an explicit total order."""
    order = []
    for c in S.PREVIEW_COLUMNS:
        order.append(F.asc_nulls_first(c))
    return enriched.select(*S.PREVIEW_COLUMNS).orderBy(*order).limit(n)
