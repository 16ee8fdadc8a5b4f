"""Per-day partial sums beside the curated table, so that marts read days, not trips.

One row for each day, hour and pickup zone that has trips: counts and sums, which add up
over days. A day's rows follow from the curated rows of that day alone; they are rewritten
with the days that a run or a micro-batch rewrites, and cleared with those it takes
away. A mart over the whole history then reads a few thousand rows a day at most, however
many trips the day has, and equals the mart over the trips.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow import schema as S
from cabflow.sinks.catalog import path_has_data
from cabflow.sinks.parquet import clear_days, write_day_partitioned

KEYS = ["pickup_date", *S.DAY_PARTITION, "pickup_hour", "pickup_borough", "pickup_zone"]
MEASURES = ("total_amount", "trip_distance")


def day_sums(curated: DataFrame) -> DataFrame:
    """Trips, and the count and sum of each measure, by day, hour and pickup zone."""
    parts = [F.count(F.lit(1)).alias("trip_count")]
    for name in MEASURES:
        parts += [F.count(name).alias(f"{name}_count"), F.sum(name).alias(f"{name}_sum")]
    return curated.groupBy(*KEYS).agg(*parts)


def on_partitions(table: DataFrame, days: Iterable[dt.date]) -> DataFrame:
    """Rows of the given days: a filter on the partition columns, so other days are not opened."""
    keys = [d.year * 10_000 + d.month * 100 + d.day for d in days]
    year, month, day = (F.col(c) for c in S.DAY_PARTITION)
    return table.filter((year * 10_000 + month * 100 + day).isin(keys))


def refresh_days(
    spark: SparkSession, curated: DataFrame, path: str, written: Iterable[dt.date], gone: Iterable[dt.date] = ()
) -> None:
    """Bring the sums up to date with days that were written to curated and days that left it."""
    written = sorted(set(written))
    kept: set[dt.date] = set()
    if written:
        kept = set(write_day_partitioned(day_sums(on_partitions(curated, written)), path, "day_sums").days)
    stale = {(d.year, d.month, d.day) for d in (set(gone) | set(written)) - kept}
    clear_days(spark, path, sorted({k[:2] for k in stale}), lambda y, m, d: (y, m, d) in stale)


def rebuild(spark: SparkSession, curated: DataFrame, path: str) -> None:
    """All days of a table that had no sums before."""
    write_day_partitioned(day_sums(curated), path, "day_sums")


def read_day_sums(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if path_has_data(spark, path) else None


def _average(name: str) -> Column:
    """The mean over all days, rounded; NULL without a value."""
    count = F.sum(f"{name}_count")
    return F.round(F.when(count > 0, F.sum(f"{name}_sum") / count), 2)


def trips_by_borough(sums: DataFrame) -> DataFrame:
    return sums.groupBy("pickup_borough").agg(
        F.sum("trip_count").alias("trip_count"),
        _average("total_amount").alias("avg_total_amount"),
        _average("trip_distance").alias("avg_trip_distance"),
    )


def trips_by_hour(sums: DataFrame) -> DataFrame:
    """Ordered by hour."""
    return (
        sums.groupBy("pickup_hour")
        .agg(
            F.sum("trip_count").alias("trip_count"),
            _average("total_amount").alias("avg_total_amount"),
            _average("trip_distance").alias("avg_trip_distance"),
        )
        .orderBy("pickup_hour")
    )


def top_pickup_zones(sums: DataFrame) -> DataFrame:
    """All (zone, borough) groups by trip count, descending; ties by zone, borough."""
    return (
        sums.groupBy("pickup_zone", "pickup_borough")
        .agg(F.sum("trip_count").alias("trip_count"), _average("total_amount").alias("avg_total_amount"))
        .orderBy(F.desc("trip_count"), F.asc_nulls_first("pickup_zone"), F.asc_nulls_first("pickup_borough"))
    )


MARTS = {
    "trips_by_borough": trips_by_borough,
    "trips_by_hour": trips_by_hour,
    "top_pickup_zones": top_pickup_zones,
}
