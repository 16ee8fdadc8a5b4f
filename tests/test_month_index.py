import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.plans.pipeline import run_pipeline, scan_period
from cabflow.sources import landing as L
from cabflow.sources import month_index as MI
from cabflow.sources import period as P
from cabflow.sources.raw import read_raw_trips
from cabflow.streaming.incremental import run_incremental_once
from tests.test_enrich import raw_frame, zones_frame
from tests.test_sinks_pipeline import _setup, _trip


def at(*ymd):
    p = dt.datetime(*ymd, 9)
    return {"tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + dt.timedelta(minutes=20)}


def test_index_holds_days_schema_and_past_days(spark, scratch):
    root = os.path.join(scratch, "raw")
    rows = [_trip(3), _trip(3), at(2031, 5, 1), {"tpep_pickup_datetime": None}]
    L.land_months({(2025, 1): raw_frame(spark, rows)}, root)
    jan = MI.stored(spark, MI.index_path(root))[MI.label_of(2025, 1)]  # written by landing
    assert jan.days == {dt.date(2025, 1, 3): 2, dt.date(2031, 5, 1): 1, None: 1}
    assert jan.row_count == 4 and jan.folders == ("year=2025/month=01",)
    L.land_months({(2025, 1): raw_frame(spark, [_trip(4)])}, root, overwrite=True)
    jan = MI.refresh(spark, root)[MI.label_of(2025, 1)]
    assert jan.days == {dt.date(2025, 1, 4): 1}
    assert jan.past == {dt.date(2025, 1, 3), dt.date(2025, 1, 4), dt.date(2031, 5, 1)}


def test_refresh_reads_only_changed_months(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "raw")
    months = {(2024, m): raw_frame(spark, [at(2024, m, 5)]) for m in range(1, 7)}
    L.land_months(months, root)
    opened = []
    footers = MI._columns_of
    monkeypatch.setattr(MI, "_columns_of", lambda s, r, folders: opened.append(tuple(folders)) or footers(s, r, folders))
    assert len(MI.refresh(spark, root)) == 6 and opened == []
    L.land_months({(2024, 7): raw_frame(spark, [at(2024, 7, 5)])}, root)
    assert opened == []  # landing knows the schema of what it wrote
    # a file that lands without the library is seen by its listing
    raw_frame(spark, [at(2024, 8, 5)]).write.parquet(f"{root}/year=2024/month=08")
    assert MI.label_of(2024, 8) in MI.refresh(spark, root) and opened == [("year=2024/month=08",)]


def test_scan_of_a_period_touches_only_folders_that_hold_it(spark, scratch):
    root = os.path.join(scratch, "raw")
    L.land_months(
        {
            (2025, 1): raw_frame(spark, [_trip(3), at(2025, 5, 2)]),  # a wrong clock, four months late
            (2025, 3): raw_frame(spark, [at(2025, 3, 3)]),
            (2025, 5): raw_frame(spark, [at(2025, 5, 4), at(2025, 5, 5)]),
        },
        root,
    )
    may = scan_period(spark, root, P.Period.parse("01/05/2025", "31/05/2025"))
    files = may.inputFiles()
    assert {f.split("/year=2025/month=")[1][:2] for f in files} == {"01", "05"}
    assert "year" not in may.columns
    assert may.filter("tpep_pickup_datetime >= '2025-05-01'").count() == 3
    none = scan_period(spark, root, P.Period.parse("01/07/2025", "31/07/2025"))
    assert none.count() == 0 and none.columns == may.columns


def test_columns_and_types_drift_over_months(spark, scratch):
    root = os.path.join(scratch, "raw")
    jan = raw_frame(spark, [_trip(3, passenger_count=2)]).drop("cbd_congestion_fee")
    feb = raw_frame(spark, [at(2025, 2, 3)]).withColumn("passenger_count", F.lit(1.5)).withColumn("surge", F.lit(7))
    feb = feb.withColumnRenamed("Airport_fee", "airport_fee")
    L.land_months({(2025, 1): jan}, root)
    L.land_months({(2025, 2): feb}, root)
    raw = read_raw_trips(spark, root)
    assert isinstance(raw.schema["passenger_count"].dataType, T.DoubleType)
    got = {r["month"]: (r["passenger_count"], r["surge"], r["cbd_congestion_fee"]) for r in raw.collect()}
    assert got[1] == (2.0, None, None) and got[2][:2] == (1.5, 7)
    assert [c.lower() for c in raw.columns].count("airport_fee") == 1
    bad = raw_frame(spark, [at(2025, 3, 3)]).withColumn("trip_distance", F.lit("far"))
    L.land_months({(2025, 3): bad}, root)
    with pytest.raises(ValueError, match="trip_distance"):
        read_raw_trips(spark, root)


def test_deleted_month_leaves_the_index_but_not_its_days(spark, scratch):
    import shutil

    root = os.path.join(scratch, "raw")
    L.land_months({(2025, m): raw_frame(spark, [at(2025, m, 5)]) for m in (1, 2)}, root)
    shutil.move(f"{root}/year=2025/month=01", os.path.join(scratch, "away"))
    index = MI.refresh(spark, root)
    assert not index[MI.label_of(2025, 1)].landed and index[MI.label_of(2025, 1)].past == {dt.date(2025, 1, 5)}
    assert read_raw_trips(spark, root).count() == 1


def test_day_filter_as_ranges_or_join(spark, scratch):
    assert MI.day_ranges([dt.date(2025, 1, d) for d in (1, 2, 3, 5)]) == [
        (dt.date(2025, 1, 1), dt.date(2025, 1, 3)), (dt.date(2025, 1, 5), dt.date(2025, 1, 5))
    ]
    raw = raw_frame(spark, [_trip(d) for d in range(1, 29)] + [{"tpep_pickup_datetime": None}])
    days = [dt.date(2025, 1, d) for d in (2, 3, 9)]
    assert MI.on_days(raw, days).count() == 3 and MI.on_days(raw, []).count() == 0
    odd = [dt.date(2025, 1, 1) + dt.timedelta(days=2 * i) for i in range(MI.MAX_RANGES + 1)]
    assert MI.on_days(raw, odd).count() == 14


def test_empty_and_broken_folders_do_not_count_as_landed(spark, scratch):
    root = os.path.join(scratch, "raw")
    folder = os.path.join(root, "year=2025", "month=01")
    os.makedirs(folder)
    assert not L.month_landed(spark, root, 2025, 1)
    with open(os.path.join(folder, "part-0.parquet"), "wb") as f:
        f.write(b"PAR1 half a file")
    assert not L.month_landed(spark, root, 2025, 1)
    assert L.land_months({(2025, 1): raw_frame(spark, [_trip(3)])}, root) == [(2025, 1)]
    assert L.month_landed(spark, root, 2025, 1)


def test_batch_after_stream_keeps_what_the_stream_wrote(spark, scratch):
    """January's file with a trip of 2 May, May's file with two: three curated rows, twice."""
    cfg = _setup(spark, scratch, [_trip(3), at(2025, 5, 2)], "after_stream")
    L.land_months({(2025, 5): raw_frame(spark, [at(2025, 5, 2), at(2025, 5, 3)])}, cfg.raw_root)
    cfg.period = P.Period.parse("01/05/2025", "31/05/2025")
    run_incremental_once(
        spark,
        raw_root=cfg.raw_root,
        zones_path=cfg.zones_path,
        curated_path=cfg.curated_path,
        rejected_path=cfg.rejected_path,
        checkpoint_root=os.path.join(scratch, "ckpt"),
        period=cfg.period,
    )
    assert spark.read.parquet(cfg.curated_path).count() == 3
    run_pipeline(spark, cfg)
    assert spark.table(cfg.curated_table).count() == 3


def test_stream_routes_undated_trips_to_rejected(spark, scratch):
    zones = os.path.join(scratch, "zones")
    zones_frame(spark).coalesce(1).write.option("header", True).csv(zones)
    root = os.path.join(scratch, "raw")
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), {"tpep_pickup_datetime": None}])}, root)
    L.land_months({(2025, 2): raw_frame(spark, [at(2025, 2, 3), {"tpep_pickup_datetime": None}])}, root)
    args = dict(
        raw_root=root,
        zones_path=zones,
        curated_path=os.path.join(scratch, "curated"),
        rejected_path=os.path.join(scratch, "rejected"),
        checkpoint_root=os.path.join(scratch, "ckpt"),
    )
    run_incremental_once(spark, **args)
    rejected = lambda: spark.read.parquet(args["rejected_path"]).filter("pickup_day is null").count()
    assert rejected() == 2 and spark.read.parquet(args["curated_path"]).count() == 2
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3)])}, root, overwrite=True)
    run_incremental_once(spark, **args)
    assert rejected() == 1
    L.land_months({(2025, 2): raw_frame(spark, [at(2025, 2, 3), _trip(5, minutes=0)])}, root, overwrite=True)
    run_incremental_once(spark, **args)
    assert rejected() == 0


def test_run_lands_its_sources_and_stops_at_the_gate(spark, scratch):
    cfg = _setup(spark, scratch, [_trip(3)], "lands")
    cfg.sources = {(2025, 2): raw_frame(spark, [_trip(8), at(2025, 2, 2)])}
    assert run_pipeline(spark, cfg).first()["curated_rows"] == 2  # 8 January came in February's file
    assert L.month_landed(spark, cfg.raw_root, 2025, 2)
    gated = _setup(spark, scratch, [_trip(3, PULocationID=999)], "gated")
    gated.validate_raw = True
    with pytest.raises(RuntimeError, match="raw expectations failed"):
        run_pipeline(spark, gated)
    assert not spark.catalog.tableExists(gated.curated_table)
