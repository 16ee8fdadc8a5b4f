import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cabflow.plans.pipeline import run_pipeline
from cabflow.sinks import versions as V
from cabflow.sources import landing as L
from cabflow.streaming.incremental import run_incremental_once
from tests.test_enrich import raw_frame, zones_frame
from tests.test_month_index import at
from tests.test_sinks_pipeline import _setup, _trip


def days(df):
    rows = df.groupBy("pickup_year", "pickup_month", "pickup_day").count().collect()
    return {(r[0], r[1], r[2]): r["count"] for r in rows}


def _versioned(spark, scratch, rows, name):
    cfg = _setup(spark, scratch, rows, name)
    cfg.versioned = True
    return cfg


def _jan(*d):
    return {(2025, 1, x): n for x, n in d}


def test_rerun_replaces_its_days_and_keeps_others(spark, scratch):
    run_pipeline(spark, _versioned(spark, scratch, [_trip(3), _trip(3), _trip(4), _trip(5, minutes=0)], "v_rerun"))
    assert days(spark.table("curated_v_rerun")) == _jan((3, 2), (4, 1))
    assert days(spark.table("rejected_v_rerun")) == _jan((5, 1))
    cfg = _versioned(spark, scratch, [_trip(3), _trip(6)], "v_rerun")
    row = run_pipeline(spark, cfg).first()
    assert row["stale_days_cleared"] == 2 and row["curated_rows"] == 2
    assert days(spark.table("curated_v_rerun")) == days(V.read_current(spark, cfg.curated_path)) == _jan((3, 1), (6, 1))
    assert spark.table("rejected_v_rerun").count() == 0
    assert days(V.read_current(spark, cfg.curated_path, 1)) == _jan((3, 2), (4, 1))  # an older state, as it was
    feb = dt.datetime(2025, 2, 2, 9)
    L.land_months({(2025, 2): raw_frame(spark, [{"tpep_pickup_datetime": feb, "tpep_dropoff_datetime": feb + dt.timedelta(minutes=9)}])}, cfg.raw_root)
    cfg.period = type(cfg.period)(dt.date(2025, 2, 1), dt.date(2025, 2, 28))
    run_pipeline(spark, cfg)
    assert days(spark.table("curated_v_rerun")) == _jan((3, 1), (6, 1)) | {(2025, 2, 2): 1}


def test_a_run_that_dies_before_publishing_changes_nothing(spark, scratch, monkeypatch):
    run_pipeline(spark, _versioned(spark, scratch, [_trip(3), _trip(4)], "v_dies"))
    cfg = _versioned(spark, scratch, [_trip(4), _trip(4), _trip(5)], "v_dies")

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(V, "commit", dies)
    with pytest.raises(OSError, match="lost"):
        run_pipeline(spark, cfg)
    assert days(spark.table("curated_v_dies")) == days(V.read_current(spark, cfg.curated_path)) == _jan((3, 1), (4, 1))
    monkeypatch.undo()
    run_pipeline(spark, cfg)
    assert days(spark.table("curated_v_dies")) == _jan((4, 2), (5, 1))


def test_a_run_that_dies_before_the_catalog_is_made_up_for(spark, scratch, monkeypatch):
    run_pipeline(spark, _versioned(spark, scratch, [_trip(3), _trip(4)], "v_late"))
    cfg = _versioned(spark, scratch, [_trip(4), _trip(4), _trip(5)], "v_late")
    done = V.sync

    def dies(spark, table, path, like, batch=200):
        if V.manifest(spark, path)[0] > 1:
            raise OSError("lost")
        return done(spark, table, path, like, batch)

    monkeypatch.setattr(V, "sync", dies)
    with pytest.raises(OSError, match="lost"):
        run_pipeline(spark, cfg)
    assert days(spark.table("curated_v_late")) == _jan((3, 1), (4, 1))  # whole old days
    assert days(V.read_current(spark, cfg.curated_path)) == _jan((4, 2), (5, 1))
    monkeypatch.undo()
    V.sync(spark, "curated_v_late", cfg.curated_path, V.read_current(spark, cfg.curated_path))
    assert days(spark.table("curated_v_late")) == _jan((4, 2), (5, 1))
    assert V.sync(spark, "curated_v_late", cfg.curated_path, V.read_current(spark, cfg.curated_path)) == 2


def _frame(spark, *rows):
    out = spark.createDataFrame([(dt.date(2025, 1, d), x) for d, x in rows], "pickup_date date, x int")
    day = F.col("pickup_date")
    return out.withColumns({"pickup_year": F.year(day), "pickup_month": F.month(day), "pickup_day": F.dayofmonth(day)})


def test_two_publishers(spark, scratch, monkeypatch):
    """The later of two runs starts over from the state of the earlier; none is lost."""
    path = os.path.join(scratch, "t")
    V.publish(spark, _frame(spark, (1, 1), (2, 1)), path, lambda d: True)
    put = V.commit

    def beaten(spark, path, number, days):
        monkeypatch.setattr(V, "commit", put)
        V.publish(spark, _frame(spark, (3, 3)), path, lambda d: d == dt.date(2025, 1, 3))
        put(spark, path, number, days)

    monkeypatch.setattr(V, "commit", beaten)
    V.publish(spark, _frame(spark, (2, 2)), path, lambda d: d == dt.date(2025, 1, 2))
    assert {r["pickup_day"]: r["x"] for r in V.read_current(spark, path).collect()} == {1: 1, 2: 2, 3: 3}
    with pytest.raises(V.Conflict):
        V.commit(spark, path, V.manifest(spark, path)[0], {})


def test_vacuum_keeps_what_recent_manifests_name(spark, scratch):
    path = os.path.join(scratch, "t")
    for x in range(4):
        V.publish(spark, _frame(spark, (1, x), (2 + x, x)), path, lambda d: d.day == 1, "t_vacuum" if x < 1 else None)
    V.write_day_partitioned(_frame(spark, (9, 9)), f"{path}/{V.FOLDER}/unpublished", "x")
    before = {(r["pickup_day"], r["x"]) for r in V.read_current(spark, path).collect()}
    assert V.vacuum(spark, path, keep=2) == 3  # the first two of day 1, and the one never published
    assert {(r["pickup_day"], r["x"]) for r in V.read_current(spark, path).collect()} == before
    assert V.read_current(spark, path, 3).count() == 4
    V.sync(spark, "t_vacuum", path, V.read_current(spark, path))  # the manifest that it shows is gone
    assert {(r["pickup_day"], r["x"]) for r in spark.table("t_vacuum").collect()} == before


def test_nothing_published(spark, scratch):
    with pytest.raises(FileNotFoundError):
        V.read_current(spark, scratch)
    V.publish(spark, _frame(spark, (1, 1)).limit(0), os.path.join(scratch, "none"), lambda d: True, "t_none")
    assert spark.table("t_none").count() == 0


@pytest.mark.parametrize("versioned", [False, True])
def test_catalog_follows_the_stream(spark, scratch, versioned):
    name = f"follow_{versioned}".lower()
    zones = os.path.join(scratch, "zones")
    zones_frame(spark).coalesce(1).write.option("header", True).csv(zones)
    root = os.path.join(scratch, "raw")
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), _trip(4), {"tpep_pickup_datetime": None}])}, root)
    args = dict(
        raw_root=root,
        zones_path=zones,
        curated_path=os.path.join(scratch, "curated"),
        rejected_path=os.path.join(scratch, "rejected"),
        checkpoint_root=os.path.join(scratch, "ckpt"),
        curated_table=f"curated_{name}",
        rejected_table=f"rejected_{name}",
        versioned=versioned,
    )
    run_incremental_once(spark, **args)
    assert days(spark.table(args["curated_table"])) == _jan((3, 1), (4, 1))
    assert days(spark.table(args["rejected_table"])) == {(None, None, None): 1}
    L.land_months({(2025, 1): raw_frame(spark, [_trip(4), _trip(4), _trip(6, minutes=0)])}, root, overwrite=True)
    L.land_months({(2025, 3): raw_frame(spark, [at(2025, 3, 1)])}, root)
    run_incremental_once(spark, **args)
    assert days(spark.table(args["curated_table"])) == _jan((4, 2)) | {(2025, 3, 1): 1}
    assert days(spark.table(args["rejected_table"])) == _jan((6, 1))
