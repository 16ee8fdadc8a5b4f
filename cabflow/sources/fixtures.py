"""Trip-shaped projection of the shared test tables.

The test tables hold no taxi trips, so ``lineitem`` is projected onto the
20-column raw trip contract and ``nation`` joined with ``region`` becomes the
zone lookup. The projection is a narrow, per-row transformation: it keeps the
scan's partitioning and adds no shuffle, so its cost grows linearly with
``lineitem``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _seconds(c: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), c)


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Project lineitem rows onto the raw trip contract (same order)."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    qty = F.col("l_quantity").cast("bigint")
    # fixed values: the projection rule of the test fixture
    p = (ok * 37 + ln * 6113) % 86400
    q = p + (pk * 13 + qty * 61) % 3600 - 30 + F.when(ok % 997 == 0, 90000).otherwise(0)
    ship = F.col("l_shipdate")
    refund = F.when((F.col("l_returnflag") == "R") & (ln == 1), -1).otherwise(1)
    line7 = ln == 7
    return lineitem.select(
        (sk % 3 + 1).cast("bigint").alias("VendorID"),
        (ship + _seconds(p)).alias("tpep_pickup_datetime"),
        F.when(pk % 1009 == 0, F.lit(None)).otherwise(ship + _seconds(q)).alias("tpep_dropoff_datetime"),
        F.when(line7, F.lit(None)).otherwise(qty % 6 + 1).alias("passenger_count"),
        F.when(pk % 499 == 0, F.col("l_quantity") * 10)
        .otherwise(F.col("l_quantity") / 4)
        .alias("trip_distance"),
        F.when(line7, F.lit(None)).otherwise(sk % 6 + 1).alias("RatecodeID"),
        F.when(line7, F.lit(None))
        .when(pk % 50 == 0, F.lit("Y"))
        .otherwise(F.lit("N"))
        .alias("store_and_fwd_flag"),
        (pk % 27 + 1).alias("PULocationID"),
        (ok % 27 + 1).alias("DOLocationID"),
        (ok % 5).alias("payment_type"),
        (refund * F.col("l_extendedprice") / 110).alias("fare_amount"),
        F.when(ln == 2, F.lit(1.0)).otherwise(F.lit(0.0)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (F.col("l_discount") * F.col("l_extendedprice") / 110).alias("tip_amount"),
        F.when(pk % 10 == 0, F.lit(6.94)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (refund * F.col("l_extendedprice") / 110 * (1 + F.col("l_tax"))).alias("total_amount"),
        F.when(line7, F.lit(None)).otherwise(F.lit(2.5)).alias("congestion_surcharge"),
        F.when(line7, F.lit(None)).otherwise(F.lit(0.0)).alias("Airport_fee"),
        F.lit(0.75).alias("cbd_congestion_fee"),
    )


def zones_from_nation_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone lookup (LocationID, Borough, Zone, service_zone) from nation x region.

    Both sides are dimension files; the planner's own size estimate decides
    the join strategy.
    """
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        (F.col("n_nationkey") + 1).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("Boro Zone"))
        .otherwise(F.lit("Yellow Zone"))
        .alias("service_zone"),
    )


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(table(spark, sf_dir, "lineitem"))


def fixture_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones_from_nation_region(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
