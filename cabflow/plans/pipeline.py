"""End-to-end run: period -> scan -> enrich -> route -> sinks -> catalog -> models -> tests."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators import enrich as E
from cabflow.operators import quality as Q
from cabflow.operators import route as R
from cabflow.plans import day_sums as D
from cabflow.plans import models as M
from cabflow.sinks import catalog as K
from cabflow.sinks import versions as V
from cabflow.sinks.catalog import path_has_data
from cabflow.sinks.parquet import by_day, write_day_partitioned
from cabflow.sources import month_index as MI
from cabflow.sources.landing import land_months
from cabflow.sources.period import Period
from cabflow.sources.raw import read_zones


@dataclass
class PipelineConfig:
    raw_root: str
    zones_path: str
    curated_path: str
    rejected_path: str
    period: Period
    curated_table: str = "curated_trips"
    rejected_table: str = "rejected_trips"
    run_ts: dt.datetime | None = None
    fail_on_test_error: bool = True
    # Monthly files to land first, by (year, month); months that are there are skipped.
    sources: dict[tuple[int, int], DataFrame | str] = field(default_factory=dict)
    # Whether the raw trips of the period must meet the expectations before anything is written.
    validate_raw: bool = False
    # Whether each table is published in one step, as versions behind a manifest.
    versioned: bool = False
    # Where to keep per-day sums of the curated table; the marts read them then.
    day_sums_path: str | None = None
    index_path: str | None = None


SUMMARY_SCHEMA = (
    "period_start date, period_end date, curated_rows bigint, rejected_rows bigint, "
    "curated_days bigint, rejected_days bigint, stale_days_cleared bigint, "
    "model_tests bigint, model_test_errors bigint"
)


def scan_period(spark: SparkSession, raw_root: str, period: Period, index_path: str | None = None) -> DataFrame:
    """Raw trips of every folder that holds a day of the period, however far its label is.

    Other folders are neither listed nor opened; the columns are those of the whole
    history, so that the tables do not depend on the period of a run.
    """
    index = MI.refresh(spark, raw_root, index_path)
    schema = MI.merged_schema(m for m in index.values() if m.landed)
    months = MI.holding(index, start=period.start, end=period.end)
    return MI.read_months(spark, raw_root, months, schema).drop("year", "month")


def _in_period(specs, period: Period):
    out = []
    for s in specs:
        if s["pickup_year"] is None:  # rows without a pickup time, from a stream without a period
            continue
        day = dt.date(s["pickup_year"], s["pickup_month"], s["pickup_day"])
        if period.start <= day <= period.end:
            out.append((day, s))
    return out


def _publish_version(spark, df: DataFrame, path: str, table: str, period: Period, name: str):
    """Write one routed output as a version and make it the content of the period's days."""
    if spark.catalog.tableExists(table):
        V.sync(spark, table, path, df)  # what an earlier run published and did not get to show
    return V.publish(spark, df, path, lambda d: d is not None and period.start <= d <= period.end, table, name, spread=False)


def _publish(spark, df: DataFrame, path: str, table: str, period: Period, name: str):
    """Write one routed output, then clear in-period days it no longer has.

    The existing days are listed from the catalog before the write; a table
    path that holds data from an earlier run is registered first so its days
    are seen even when the catalog itself is new.
    """
    before = []
    if spark.catalog.tableExists(table):
        before = _in_period(K.existing_partitions(spark, table, (period.start.year, period.end.year)), period)
    elif K.path_has_data(spark, path):
        K.register_table(spark, table, path, df)  # first sight of old data: one full repair
        before = _in_period(K.existing_partitions(spark, table, (period.start.year, period.end.year)), period)
    written = write_day_partitioned(df, path, name, spread=False)
    K.create_table(spark, table, path, df)
    K.add_partitions(
        spark,
        table,
        [{"pickup_year": d.year, "pickup_month": d.month, "pickup_day": d.day} for d in written.days],
    )
    keep = set(written.days)
    stale = [spec for day, spec in before if day not in keep]
    K.clear_partitions(spark, table, path, stale)
    return written, len(stale)


def _day_sums(spark: SparkSession, cfg: PipelineConfig, cur) -> DataFrame:
    """The per-day sums after this run: all days the first time, then those of the period."""
    curated = spark.table(cfg.curated_table)
    if not path_has_data(spark, cfg.day_sums_path):
        D.rebuild(spark, curated, cfg.day_sums_path)
    else:
        held = cfg.period.end - cfg.period.start
        whole = {cfg.period.start + dt.timedelta(days=k) for k in range(held.days + 1)}
        D.refresh_days(spark, curated, cfg.day_sums_path, cur.days, whole - set(cur.days))
    sums = D.read_day_sums(spark, cfg.day_sums_path)
    return D.day_sums(curated) if sums is None else sums


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Run the whole job for one period; a step that fails, fails the run.

    Months given as ``sources`` are landed first. With ``validate_raw`` the expectations
    are checked on the raw trips to be read, and a failing one stops the run before
    anything is written.
    The model tests come last and read the staging view once; with
    ``fail_on_test_error`` (the default) a failing test raises after the tables
    are written. Returns a one-row summary built from metrics observed during the
    writes (no extra pass over the data).
    """
    run_ts = cfg.run_ts or dt.datetime.now(dt.timezone.utc)
    if cfg.sources:
        land_months(cfg.sources, cfg.raw_root, index_path=cfg.index_path)
    raw = scan_period(spark, cfg.raw_root, cfg.period, cfg.index_path)
    if cfg.validate_raw:
        results = Q.raw_expectations(raw)
        if not Q.gate(results):
            failed = [r["expectation"] for r in results.filter("NOT success").collect()]  # seven rows at most
            raise RuntimeError(f"raw expectations failed: {failed}")
    zones = read_zones(spark, cfg.zones_path)
    enriched = E.enrich(by_day(raw), zones, run_ts=run_ts)
    routed = R.route(enriched, cfg.period)
    publish = _publish_version if cfg.versioned else _publish
    cur, stale_c = publish(spark, routed.curated, cfg.curated_path, cfg.curated_table, cfg.period, "curated")
    rej, stale_r = publish(spark, routed.rejected, cfg.rejected_path, cfg.rejected_table, cfg.period, "rejected")
    sums = _day_sums(spark, cfg, cur) if cfg.day_sums_path else None
    views = M.register_models(spark, spark.table(cfg.curated_table), spark.table(cfg.rejected_table), sums)
    tests = Q.model_tests(views["stg_trips"]).collect()  # six rows
    failed = [f"{t['model']}.{t['column_name']}" for t in tests if t["status"] == "ERROR"]
    if failed and cfg.fail_on_test_error:
        raise RuntimeError(f"model tests failed: {failed}")
    errors = len(failed)
    row = (
        cfg.period.start,
        cfg.period.end,
        cur.rows,
        rej.rows,
        len(cur.days),
        len(rej.days),
        stale_c + stale_r,
        len(tests),
        errors,
    )
    return spark.createDataFrame([row], SUMMARY_SCHEMA)
