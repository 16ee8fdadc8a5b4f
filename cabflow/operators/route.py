"""Processing-period filter, curated/rejected routing and reconciliation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions import trip_columns as C
from cabflow.sources.period import Period


def filter_period(enriched: DataFrame, period: Period) -> DataFrame:
    """Rows whose pickup date lies in the period (both ends inclusive).

    Out-of-period rows, and rows without a pickup time, are dropped here, not
    rejected. Catalyst pushes the predicate below the zone joins into the scan.
    """
    return enriched.filter(C.in_period("pickup_datetime", period.start, period.end))


def curated(in_period: DataFrame) -> DataFrame:
    """Rows not flagged as anomalous (a NULL flag is not curated)."""
    return in_period.filter(~C.is_rejected())


def rejected(in_period: DataFrame) -> DataFrame:
    """Rows flagged as anomalous, plus rows whose flag is NULL."""
    return in_period.filter(C.is_rejected())


@dataclass
class Routed:
    in_period: DataFrame
    curated: DataFrame
    rejected: DataFrame


def route(enriched: DataFrame, period: Period) -> Routed:
    scoped = filter_period(enriched, period)
    return Routed(scoped, curated(scoped), rejected(scoped))


def reconciliation(enriched: DataFrame, period: Period) -> DataFrame:
    """One row: input, out-of-period, in-period, curated, rejected, loss, ok.

    Computed in a single aggregation pass over the enriched input; each
    in-period row is counted in exactly one of curated / rejected.
    """
    inside = F.coalesce(C.in_period("pickup_datetime", period.start, period.end), F.lit(False))
    rej = C.is_rejected()
    agg = enriched.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(~inside).alias("out_of_period_rows"),
        F.count_if(inside).alias("in_period_rows"),
        F.count_if(inside & ~rej).alias("curated_rows"),
        F.count_if(inside & rej).alias("rejected_rows"),
        F.count_if(inside & F.col("is_anomalous_trip").isNull()).alias("null_flag_rows"),
    )
    loss = F.col("in_period_rows") - F.col("curated_rows") - F.col("rejected_rows")
    return agg.withColumns({"loss_rows": loss, "reconciled": loss == 0})
