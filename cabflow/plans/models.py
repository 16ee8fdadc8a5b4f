"""Staging and mart models over the curated table.

Each model is a lazy ``DataFrame``; :func:`register_models` publishes them as
temporary views in dependency order (source -> ``stg_trips`` -> marts) so SQL
users can query them by name. Catalyst inlines view-on-view and prunes the
scan to the columns each mart reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow import schema as S
from cabflow.plans import day_sums as D


def stg_trips(curated: DataFrame) -> DataFrame:
    """27 of the curated columns, no filter."""
    return curated.select(*S.STG_COLUMNS)


def _avg2(name: str) -> F.Column:
    return F.round(F.avg(name), 2)


def trips_by_borough(stg: DataFrame) -> DataFrame:
    return stg.groupBy("pickup_borough").agg(
        F.count(F.lit(1)).alias("trip_count"),
        _avg2("total_amount").alias("avg_total_amount"),
        _avg2("trip_distance").alias("avg_trip_distance"),
    )


def trips_by_hour(stg: DataFrame) -> DataFrame:
    """Ordered by hour; 24 rows at most, so the final sort is trivial."""
    return (
        stg.groupBy("pickup_hour")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            _avg2("total_amount").alias("avg_total_amount"),
            _avg2("trip_distance").alias("avg_trip_distance"),
        )
        .orderBy("pickup_hour")
    )


def top_pickup_zones(stg: DataFrame) -> DataFrame:
    """All (zone, borough) groups by trip count, descending; ties by zone, borough."""
    return (
        stg.groupBy("pickup_zone", "pickup_borough")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            _avg2("total_amount").alias("avg_total_amount"),
        )
        .orderBy(
            F.desc("trip_count"),
            F.asc_nulls_first("pickup_zone"),
            F.asc_nulls_first("pickup_borough"),
        )
    )


MARTS = {
    "trips_by_borough": trips_by_borough,
    "trips_by_hour": trips_by_hour,
    "top_pickup_zones": top_pickup_zones,
}


def register_models(
    spark: SparkSession, curated: DataFrame, rejected: DataFrame | None = None, sums: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Create the views in dependency order and return them by name.

    With the per-day ``sums`` of the curated table the marts read those instead of trips.
    """
    views: dict[str, DataFrame] = {}
    curated.createOrReplaceTempView("curated_trips_source")
    if rejected is not None:
        rejected.createOrReplaceTempView("rejected_trips_source")
    stg = stg_trips(spark.table("curated_trips_source"))
    stg.createOrReplaceTempView("stg_trips")
    views["stg_trips"] = spark.table("stg_trips")
    marts, source = (MARTS, spark.table("stg_trips")) if sums is None else (D.MARTS, sums)
    for name, build in marts.items():
        build(source).createOrReplaceTempView(name)
        views[name] = spark.table(name)
    return views
