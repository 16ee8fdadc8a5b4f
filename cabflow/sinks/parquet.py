"""Parquet and JSON sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cabflow import schema as S
from cabflow.sources.month_index import PICKUP, pickup_time


@dataclass
class WriteResult:
    rows: int
    days: list[dt.date] = field(default_factory=list)
    undated: int = 0  # rows without a day


def by_day(raw: DataFrame) -> DataFrame:
    """Raw trips rebalanced by pickup day, for a write by day that follows.

    The columns and zones that enrichment adds double the width of a row; they are added
    behind the shuffle. Filters on the trips are pushed below it, so each of two routed
    outputs shuffles its own rows only.
    """
    if PICKUP not in raw.columns:
        return raw
    days = raw.withColumn("__day", F.to_date(pickup_time(raw)))
    return days.hint("rebalance", "__day").drop("__day")


def write_day_partitioned(df: DataFrame, path: str, name: str = "write", spread: bool = True) -> WriteResult:
    """Write ``df`` by (pickup_year, pickup_month, pickup_day), replacing only
    the days present in ``df`` (dynamic partition overwrite).

    ``REBALANCE`` on the day keys groups each day's rows into few files while
    AQE splits an oversized day across several tasks and merges small ones.
    The row count and the set of written days are observed during the write
    itself: no second pass. The day set is bounded by the days of the
    processing period. Without ``spread`` the rows are taken as they come: those made
    of :func:`by_day` are grouped already.
    """
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.collect_set("pickup_date").alias("days"),
        F.count_if(F.col("pickup_date").isNull()).alias("undated"),
    ]
    obs = Observation(f"{name}_{uuid.uuid4().hex}")  # names must not repeat in a session
    observed = df.observe(obs, *metrics)
    grouped = observed.hint("rebalance", *S.DAY_PARTITION) if spread else observed
    (
        grouped.write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*S.DAY_PARTITION)
        .parquet(path)
    )
    try:
        got = obs.get
    except Py4JJavaError:
        # AQE replaces a plan it proves empty, and the observation goes with it:
        # there is nothing to read but the metrics of (almost always) no rows.
        got = df.agg(*metrics).first().asDict()
    return WriteResult(int(got.get("rows") or 0), sorted(got.get("days") or []), int(got.get("undated") or 0))


def clear_undated(spark: SparkSession, path: str) -> None:
    """Delete the folder of rows without a day."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{S.DAY_PARTITION[0]}=__HIVE_DEFAULT_PARTITION__")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clear_days(
    spark: SparkSession, path: str, months: list[tuple[int, int]], stale: Callable[[int, int, int], bool]
) -> list[dt.date]:
    """Delete the day folders of the given months that ``stale(y, m, d)`` names; return their days.

    Folders are listed month by month, so the cost does not grow with the history.
    """
    gone = []
    for year, month in months:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/pickup_year={year}/pickup_month={month}")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith("pickup_day=") and stale(year, month, int(name.partition("=")[2])):
                fs.delete(status.getPath(), True)
                gone.append(dt.date(year, month, int(name.partition("=")[2])))
    return gone


def write_sample(df: DataFrame, path: str, n: int = S.SAMPLE_SIZE) -> None:
    """First ``n`` rows as one Parquet output (a sample is the feature here)."""
    df.limit(n).write.mode("overwrite").parquet(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report frame as a single JSON document."""
    report.coalesce(1).write.mode("overwrite").json(path)
