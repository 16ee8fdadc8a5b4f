"""Incremental mode of the job with Structured Streaming.

Months keep landing under ``year=YYYY/month=MM``, and a month may be landed again.
A file stream over the raw root tells which months have new files; each micro-batch
(``foreachBatch``) rewrites the days of those months, and all other days that their
files hold or held, from the raw layout with the day overwrite of the batch job.
Running a batch twice, or landing a month again, therefore gives the same tables, and
batch runs and streaming runs can share them. A file may hold pickups of any month: the
month index that batch runs use too says which folders to read for a day, and which days
a folder held before it landed again.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cabflow.operators import enrich as E
from cabflow.operators import route as R
from cabflow.plans import day_sums as D
from cabflow.sinks import catalog as K
from cabflow.sinks import versions as V
from cabflow.sinks.parquet import by_day, clear_days, clear_undated, write_day_partitioned
from cabflow.sources import month_index as MI
from cabflow.sources.period import Period
from cabflow.sources.raw import read_zones


def raw_stream(spark: SparkSession, raw_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of the raw layout; only the year and month of the folders are read."""
    reader = spark.readStream.schema("year int, month int").option("basePath", raw_root)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(raw_root).select("year", "month")


def affected_days(index: dict[int, MI.Month], touched: list[int], period: Period | None) -> set[dt.date | None]:
    """Days of the touched months, and days that their folders hold or ever held.

    None stands for trips without a pickup time, which no period covers.
    """
    mine = [index[k] for k in touched if k in index]
    days = {d for m in mine for d in (*m.days, *m.past)}
    days |= {d for m in index.values() for d in m.days if d and MI.label_of(d.year, d.month) in touched}
    if period:
        return {d for d in days if d and period.start <= d <= period.end}
    return days | {None}


def affected_trips(
    spark: SparkSession, raw_root: str, touched: list[int], period: Period | None = None, index_path: str | None = None
) -> tuple[DataFrame, set[dt.date | None]]:
    """Raw trips of every day of the touched months or their files, and those days.

    Each day is read from all folders that hold it, however far their label is.
    ``touched`` are month labels, bounded by the files of a micro-batch; the days are
    bounded by the calendar, and by ``period`` if set.
    """
    index = MI.refresh(spark, raw_root, index_path)
    days = affected_days(index, touched, period)
    schema = MI.merged_schema(m for m in index.values() if m.landed)
    raw = MI.read_months(spark, raw_root, MI.holding(index, days), schema)
    trips = MI.on_days(raw, days - {None})
    if None in days:
        undated = MI.read_months(spark, raw_root, MI.holding(index, {None}), schema)
        trips = trips.unionByName(undated.filter(MI.pickup_time(undated).isNull()))
    return trips.drop("year", "month"), days


def rewrite_months(
    spark: SparkSession,
    touched: list[int],
    raw_root: str,
    zones_path: str,
    curated_path: str,
    rejected_path: str,
    period: Period | None = None,
    run_ts: dt.datetime | None = None,
    index_path: str | None = None,
    curated_table: str | None = None,
    rejected_table: str | None = None,
    versioned: bool = False,
    day_sums_path: str | None = None,
) -> None:
    """Rewrite both tables for the days of the touched months and of their files.

    Without a period every trip is routed: those without a pickup time have a NULL flag
    and go to rejected, below the default folder of a NULL day. Tables that are named
    follow each batch; with ``versioned`` a batch is published in one step.
    """
    trips, days = affected_trips(spark, raw_root, touched, period, index_path)
    enriched = E.enrich(by_day(trips), read_zones(spark, zones_path), run_ts=run_ts or dt.datetime.now(dt.timezone.utc))
    scoped = R.filter_period(enriched, period) if period else enriched
    own = {(m // 12, m % 12 + 1) for m in touched}
    affected = {(d.year, d.month, d.day) for d in days if d}
    months = sorted(own | {d[:2] for d in affected})
    inside = lambda y, m, d: period is None or period.start <= dt.date(y, m, d) <= period.end
    for name, frame, path, table in (
        ("curated", R.curated(scoped), curated_path, curated_table),
        ("rejected", R.rejected(scoped), rejected_path, rejected_table),
    ):
        sums = day_sums_path if name == "curated" else None
        if versioned:
            written, _ = V.publish(spark, frame, path, lambda d: d in days, table, name, spread=False)
            if sums:
                current = V.read_current(spark, path) if written.days else frame
                D.refresh_days(spark, current, sums, written.days, days - {None})
            continue
        written = write_day_partitioned(frame, path, name, spread=False)
        keep = {(d.year, d.month, d.day) for d in written.days}
        mine = lambda y, m, d: (y, m) in own or (y, m, d) in affected
        gone = clear_days(spark, path, months, lambda y, m, d: (y, m, d) not in keep and mine(y, m, d) and inside(y, m, d))
        if None in days and not written.undated:
            clear_undated(spark, path)
        if table:
            held = set(written.days) | ({None} if written.undated else set())
            K.follow_batch(spark, table, path, frame, held, days | set(gone))
        if sums:
            current = spark.read.parquet(path) if written.days else frame
            D.refresh_days(spark, current, sums, written.days, (days | set(gone)) - {None})


def start_incremental(
    spark: SparkSession,
    raw_root: str,
    zones_path: str,
    curated_path: str,
    rejected_path: str,
    checkpoint_root: str,
    period: Period | None = None,
    run_ts: dt.datetime | None = None,
    available_now: bool = True,
    index_path: str | None = None,
    curated_table: str | None = None,
    rejected_table: str | None = None,
    versioned: bool = False,
    day_sums_path: str | None = None,
) -> StreamingQuery:
    """Start the stream; ``checkpoint_root`` must be on storage shared by the cluster.

    With ``period`` set only pickups inside it are routed, as in the batch job;
    NULL flags go to rejected. ``run_ts`` fixes the processing time (tests);
    without it every micro-batch carries its own.
    """

    def process(batch: DataFrame, _batch_id: int) -> None:
        months = batch.select(F.col("year").cast("int"), F.col("month").cast("int")).distinct().collect()
        if months:  # one row per landed month
            touched = sorted(MI.label_of(r[0], r[1]) for r in months)
            rewrite_months(
                batch.sparkSession, touched, raw_root, zones_path, curated_path, rejected_path, period, run_ts, index_path,
                curated_table, rejected_table, versioned, day_sums_path,
            )
            for table in filter(None, (curated_table, rejected_table)):
                spark.catalog.refreshTable(table)  # the batch has a session, and a cache of file lists, of its own

    writer = (
        raw_stream(spark, raw_root)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", os.path.join(checkpoint_root, "months"))
        .queryName(f"incremental_{os.path.basename(checkpoint_root.rstrip('/'))}")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_incremental_once(spark: SparkSession, **kwargs) -> None:
    """Catch up on every month with files not yet seen, then stop."""
    query = start_incremental(spark, available_now=True, **kwargs)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
