import os

import pytest
from pyspark.sql import functions as F

from cabflow.plans import day_sums as D
from cabflow.plans import models as M
from cabflow.plans.pipeline import run_pipeline
from cabflow.sources import landing as L
from cabflow.streaming.incremental import run_incremental_once
from tests.test_enrich import raw_frame, zones_frame
from tests.test_month_index import at
from tests.test_sinks_pipeline import _setup, _trip


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def same_marts(curated, sums):
    for name, build in M.MARTS.items():
        assert rows(D.MARTS[name](sums)) == rows(build(M.stg_trips(curated))), name


@pytest.mark.parametrize("versioned", [False, True])
def test_marts_follow_runs(spark, scratch, versioned):
    name = f"sums_{versioned}".lower()
    first = [_trip(3, total_amount=10.5), _trip(3, total_amount=None), _trip(4, trip_distance=2.25), _trip(5, PULocationID=999)]
    cfg = _setup(spark, scratch, first, name)
    cfg.versioned, cfg.fail_on_test_error = versioned, False
    cfg.day_sums_path = os.path.join(scratch, "sums")
    run_pipeline(spark, cfg)
    same_marts(spark.table(cfg.curated_table), D.read_day_sums(spark, cfg.day_sums_path))
    # the third changes, the fourth goes, a stray of another file comes
    again = _setup(spark, scratch, [_trip(3, total_amount=7.0), _trip(6), _trip(5, PULocationID=999)], name)
    L.land_months({(2025, 3): raw_frame(spark, [_trip(9), at(2025, 3, 1)])}, cfg.raw_root)
    again.versioned, again.fail_on_test_error, again.day_sums_path = versioned, False, cfg.day_sums_path
    run_pipeline(spark, again)
    sums = D.read_day_sums(spark, cfg.day_sums_path)
    assert {r[0] for r in sums.select("pickup_day").distinct().collect()} == {3, 5, 6, 9}
    same_marts(spark.table(cfg.curated_table), sums)
    assert rows(spark.table("trips_by_borough")) == rows(D.trips_by_borough(sums))
    plan = spark.table("trips_by_hour")._jdf.queryExecution().executedPlan().toString()
    assert "/sums" in plan and "/curated" not in plan


@pytest.mark.parametrize("versioned", [False, True])
def test_sums_follow_the_stream(spark, scratch, versioned):
    zones = os.path.join(scratch, "zones")
    zones_frame(spark).coalesce(1).write.option("header", True).csv(zones)
    root = os.path.join(scratch, "raw")
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), _trip(4), _trip(5, minutes=0)])}, root)
    args = dict(
        raw_root=root,
        zones_path=zones,
        curated_path=os.path.join(scratch, "curated"),
        rejected_path=os.path.join(scratch, "rejected"),
        checkpoint_root=os.path.join(scratch, "ckpt"),
        curated_table=f"curated_stream_sums_{versioned}",
        versioned=versioned,
        day_sums_path=os.path.join(scratch, "sums"),
    )
    for landed in ([_trip(3), _trip(4), _trip(5, minutes=0)], [_trip(4), _trip(4), at(2025, 2, 7)], [_trip(5, minutes=0)]):
        L.land_months({(2025, 1): raw_frame(spark, landed)}, root, overwrite=True)
        run_incremental_once(spark, **args)
        sums = D.read_day_sums(spark, args["day_sums_path"])
        curated = spark.table(args["curated_table"])
        if sums is None:
            assert curated.count() == 0
            continue
        same_marts(curated, sums)
        assert sums.agg(F.sum("trip_count")).first()[0] == curated.count()


def test_only_the_given_days_are_opened(spark, scratch):
    cfg = _setup(spark, scratch, [_trip(3), _trip(4), _trip(5)], "sums_days")
    run_pipeline(spark, cfg)
    import datetime as dt

    some = D.on_partitions(spark.table(cfg.curated_table), [dt.date(2025, 1, 4)])
    assert some.count() == 1
    assert [f.split("pickup_day=")[1][:2] for f in some.inputFiles()] == ["4/"]
