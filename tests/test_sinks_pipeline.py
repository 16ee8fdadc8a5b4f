import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cabflow.plans.pipeline import PipelineConfig, run_pipeline
from cabflow.sources import landing as L
from cabflow.sources import period as P
from cabflow.sources.raw import read_raw_trips, read_zones
from cabflow.sinks import catalog as K
from cabflow.sinks.parquet import by_day, write_day_partitioned, write_json_report, write_sample
from tests.test_enrich import TS, raw_frame, zones_frame


def _trip(day, minutes=10, **kw):
    p = TS(2025, 1, day, 9, 0, 0)
    return {"tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + dt.timedelta(minutes=minutes), **kw}


def _setup(spark, scratch, rows, name):
    raw_root = os.path.join(scratch, "raw")
    L.land_months({(2025, 1): raw_frame(spark, rows)}, raw_root, overwrite=True)
    zones = os.path.join(scratch, "zones")
    zones_frame(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(zones)
    return PipelineConfig(
        raw_root=raw_root,
        zones_path=zones,
        curated_path=os.path.join(scratch, "curated"),
        rejected_path=os.path.join(scratch, "rejected"),
        period=P.Period.parse("01/01/2025", "31/01/2025"),
        curated_table=f"curated_{name}",
        rejected_table=f"rejected_{name}",
    )


def test_landing_layout_skip_and_empty_guard(spark, scratch):
    root = os.path.join(scratch, "raw")
    rows = [_trip(3), _trip(4)]
    jan = {(2025, 1): raw_frame(spark, rows)}
    assert L.land_months(jan, root) == [(2025, 1)]
    assert os.path.isdir(os.path.join(root, "year=2025", "month=01"))
    assert L.land_months(jan, root) == []  # already present: skipped
    assert L.land_months(jan, root, overwrite=True) == [(2025, 1)]
    assert read_raw_trips(spark, root).count() == 2
    with pytest.raises(ValueError, match="no source rows"):
        L.land_months({(2025, 2): raw_frame(spark, rows).limit(0)}, root)


def test_landing_keeps_the_whole_file(spark, scratch):
    root = os.path.join(scratch, "raw")
    rows = [_trip(3), {"tpep_pickup_datetime": None}, {"tpep_pickup_datetime": TS(2031, 5, 1, 9, 0, 0)}]
    file = os.path.join(scratch, "january.parquet")
    raw_frame(spark, rows).write.parquet(file)
    assert L.land_months({(2025, 1): file}, root) == [(2025, 1)]
    back = read_raw_trips(spark, root)
    assert back.count() == 3 and back.filter("tpep_pickup_datetime is null").count() == 1
    assert {(r["year"], r["month"]) for r in back.select("year", "month").distinct().collect()} == {(2025, 1)}


def test_skip_check_reads_no_data(spark, scratch):
    root = os.path.join(scratch, "raw")
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3)])}, root)
    assert L.month_landed(spark, root, 2025, 1) and not L.month_landed(spark, root, 2025, 2)


def test_months_with_different_columns_are_merged(spark, scratch):
    root = os.path.join(scratch, "raw")
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3)]).drop("cbd_congestion_fee")}, root)
    L.land_months({(2025, 2): raw_frame(spark, [{"cbd_congestion_fee": 0.75}])}, root)
    fees = {r["month"]: r["cbd_congestion_fee"] for r in read_raw_trips(spark, root).collect()}
    assert fees == {1: None, 2: 0.75}


def test_zone_columns_by_name(spark, scratch):
    path = os.path.join(scratch, "z")
    zones = zones_frame(spark)
    zones.select("service_zone", "Zone", "LocationID", "Borough").withColumn("extra", F.lit(1)).write.option("header", True).csv(path)
    assert sorted(map(tuple, read_zones(spark, path).collect())) == sorted(map(tuple, zones.collect()))


def test_new_columns_reach_an_existing_table(spark, scratch):
    cfg = _setup(spark, scratch, [_trip(3)], "new_column")
    run_pipeline(spark, cfg)
    wider = spark.table("curated_new_column").withColumn("surge", F.lit(1.5))
    K.create_table(spark, "curated_new_column", cfg.curated_path, wider)
    assert "surge" in spark.table("curated_new_column").columns
    assert spark.table("curated_new_column").filter("surge is null").count() == 1


def test_failing_model_test_fails_the_run(spark, scratch):
    rows = [_trip(3, PULocationID=9999)]
    cfg = _setup(spark, scratch, rows, "failing")
    with pytest.raises(RuntimeError, match="trips_by_borough.pickup_borough"):
        run_pipeline(spark, cfg)
    assert spark.table("curated_failing").count() == 1  # the tables are written before


def test_zone_csv_roundtrip_and_required_columns(spark, scratch):
    path = os.path.join(scratch, "z")
    zones_frame(spark).write.option("header", True).csv(path)
    assert read_zones(spark, path).count() == 2
    bad = os.path.join(scratch, "zbad")
    zones_frame(spark).drop("Zone").write.option("header", True).csv(bad)
    with pytest.raises(ValueError, match="Zone"):
        read_zones(spark, bad)


def test_pipeline_rerun_idempotent_keeps_other_days_and_clears_stale(spark, scratch):
    rows = [_trip(3), _trip(3), _trip(4), _trip(5, minutes=0), _trip(6, tpep_dropoff_datetime=None)]
    cfg = _setup(spark, scratch, rows, "a")
    [s1] = run_pipeline(spark, cfg).collect()
    assert (s1["curated_rows"], s1["rejected_rows"]) == (3, 2)
    assert spark.table("curated_a").count() == 3 and spark.table("rejected_a").count() == 2
    # rerun: same result, nothing duplicated
    [s2] = run_pipeline(spark, cfg).collect()
    assert spark.table("curated_a").count() == 3 and s2["stale_days_cleared"] == 0
    # a day outside the new period survives; a day that lost all rows is cleared
    cfg_only3 = PipelineConfig(**{**cfg.__dict__, "period": P.Period.parse("03/01/2025", "05/01/2025")})
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), _trip(4), _trip(5)])}, cfg.raw_root, overwrite=True)
    [s3] = run_pipeline(spark, cfg_only3).collect()
    days = sorted(r["pickup_day"] for r in spark.table("rejected_a").select("pickup_day").distinct().collect())
    assert days == [6]  # day 5 lost its only rejected row: cleared; day 6 is outside the rerun period
    assert s3["rejected_rows"] == 0 and s3["curated_rows"] == 3 and s3["stale_days_cleared"] == 1
    cur_days = sorted(r["pickup_day"] for r in spark.table("curated_a").select("pickup_day").distinct().collect())
    assert cur_days == [3, 4, 5]
    assert spark.table("curated_a").count() == 3  # day 3 rewritten with one row


def test_stale_day_removed_when_day_becomes_empty(spark, scratch):
    rows = [_trip(3), _trip(4, minutes=0)]
    cfg = _setup(spark, scratch, rows, "b")
    run_pipeline(spark, cfg).collect()
    assert spark.table("rejected_b").count() == 1
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), _trip(4)])}, cfg.raw_root, overwrite=True)
    [s] = run_pipeline(spark, cfg).collect()
    assert s["rejected_rows"] == 0 and s["stale_days_cleared"] == 1
    assert spark.table("rejected_b").count() == 0
    assert spark.table("curated_b").count() == 2


def test_sample_and_json_report_sinks(spark, scratch):
    df = raw_frame(spark, [{"VendorID": i} for i in range(20)])
    write_sample(df, os.path.join(scratch, "sample"), n=7)
    assert spark.read.parquet(os.path.join(scratch, "sample")).count() == 7
    from cabflow.operators.profile import profile_report

    sample = os.path.join(scratch, "sample")
    write_json_report(profile_report(df, 2025, 1, "x", sample), os.path.join(scratch, "report"))
    [doc] = spark.read.json(os.path.join(scratch, "report")).collect()
    assert doc["dataset"]["row_count"] == 20
    files = [os.path.join(sample, f) for f in os.listdir(sample) if f.endswith(".parquet")]
    assert doc["file_size_mb"] == round(sum(map(os.path.getsize, files)) / 2**20, 2)


def test_day_write_shuffles_raw_trips_only(spark, scratch):
    """The shuffle by day lies below enrichment and above the route's filter; no other one follows."""
    from cabflow.operators import enrich as E
    from cabflow.operators import route as R

    rows = [_trip(d, minutes) for d in (3, 4, 4) for minutes in (10, -5)]
    raw = by_day(raw_frame(spark, [*rows, {"tpep_pickup_datetime": None}]))
    assert raw.columns == raw_frame(spark, rows).columns
    out = R.curated(E.enrich(raw, zones_frame(spark)))
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    shuffle = next(i for i, x in enumerate(lines) if "RebalancePartitions" in x)
    assert max(i for i, x in enumerate(lines) if "Join" in x) < shuffle
    assert any("Filter" in x and "tpep_dropoff_datetime" in x for x in lines[shuffle:])
    got = write_day_partitioned(out, os.path.join(scratch, "days"), spread=False)
    assert got.rows == 3 and got.days == [dt.date(2025, 1, 3), dt.date(2025, 1, 4)]
    assert spark.read.parquet(os.path.join(scratch, "days")).groupBy("pickup_day").count().count() == 2
