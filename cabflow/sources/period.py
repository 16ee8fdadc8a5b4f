"""Processing period: parameters, month plan and raw-month coverage."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow import schema as S


@dataclass(frozen=True)
class Period:
    """Inclusive calendar period [start, end]."""

    start: dt.date
    end: dt.date

    @classmethod
    def parse(cls, start: str, end: str, min_year: int = S.MIN_RAW_YEAR) -> "Period":
        """Strict ``dd/MM/yyyy`` pair; end before start, or a month before the
        raw feed exists, is an error."""
        s = dt.datetime.strptime(start, S.PERIOD_FORMAT).date()
        e = dt.datetime.strptime(end, S.PERIOD_FORMAT).date()
        if e < s:
            raise ValueError("end date must be on or after start date")
        if s.year < min_year:
            raise ValueError(f"year must be {min_year} or later")
        return cls(s, e)

    @classmethod
    def from_iso(cls, start: str, end: str) -> "Period":
        s, e = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
        if e < s:
            raise ValueError("end date must be on or after start date")
        return cls(s, e)

    def month_keys(self, widen: int = 0) -> tuple[int, int]:
        """First and last ``year*100+month`` touched, widened by ``widen`` months."""

        def shift(d: dt.date, k: int) -> int:
            m = d.year * 12 + d.month - 1 + k
            return (m // 12) * 100 + m % 12 + 1

        return shift(self.start, -widen), shift(self.end, widen)


def month_plan(spark: SparkSession, period: Period) -> DataFrame:
    """One row per month touched by the period: (year, month).

    Built by Spark from the two dates; its size is the period length in
    months, never the data size.
    """
    return (
        spark.range(1)
        .select(
            F.explode(
                F.sequence(
                    F.trunc(F.lit(period.start), "MM"),
                    F.trunc(F.lit(period.end), "MM"),
                    F.expr("interval 1 month"),
                )
            ).alias("month_start")
        )
        .select(
            F.year("month_start").alias("year"),
            F.month("month_start").alias("month"),
        )
    )


def period_coverage(trips: DataFrame, period: Period, year: Column | None = None, month: Column | None = None) -> DataFrame:
    """Months of the period with their raw row count (0 = month missing).

    ``year``/``month`` default to the pickup time's calendar parts, with a plain
    range on the pickup time that reaches the scan; pass the ``year``/``month``
    partition columns of a landed layout to count by file placement instead. The
    trips are aggregated to one row per month before the join.
    """
    spark = trips.sparkSession
    if year is None and month is None:
        pickup = F.col("tpep_pickup_datetime")
        first = period.start.replace(day=1)
        after = (period.end.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        kind = trips.schema["tpep_pickup_datetime"].dataType
        trips = trips.filter((pickup >= F.lit(first).cast(kind)) & (pickup < F.lit(after).cast(kind)))
    year = year if year is not None else F.year("tpep_pickup_datetime")
    month = month if month is not None else F.month("tpep_pickup_datetime")
    lo, hi = period.month_keys()
    counts = (
        trips.select(year.cast("int").alias("year"), month.cast("int").alias("month"))
        .filter((F.col("year") * 100 + F.col("month")).between(lo, hi))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return month_plan(spark, period).join(counts, ["year", "month"], "left").select(
        "year", "month", F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count")
    )


def prune_raw_months(raw: DataFrame, period: Period, widen: int = 1) -> DataFrame:
    """Keep only raw partitions near the period (partition pruning on year/month).

    Files may hold stray rows of neighbouring months, so the range is widened
    by ``widen`` months each way; the exact date filter comes later.
    """
    lo, hi = period.month_keys(widen)
    return raw.filter((F.col("year") * 100 + F.col("month")).between(lo, hi))
