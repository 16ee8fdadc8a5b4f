import os

from cabflow.sources import landing as L
from cabflow.streaming.incremental import run_incremental_once
from tests.test_enrich import raw_frame, zones_frame
from tests.test_sinks_pipeline import _trip


def test_incremental_processes_each_file_once(spark, scratch):
    raw_root = os.path.join(scratch, "raw")
    zones = os.path.join(scratch, "zones")
    zones_frame(spark).coalesce(1).write.option("header", True).csv(zones)
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), _trip(4), _trip(5, minutes=0)])}, raw_root)
    args = dict(
        raw_root=raw_root,
        zones_path=zones,
        curated_path=os.path.join(scratch, "curated"),
        rejected_path=os.path.join(scratch, "rejected"),
        checkpoint_root=os.path.join(scratch, "ckpt"),
    )
    run_incremental_once(spark, **args)
    assert spark.read.parquet(args["curated_path"]).count() == 2
    assert spark.read.parquet(args["rejected_path"]).count() == 1
    # nothing new landed: a rerun adds nothing
    run_incremental_once(spark, **args)
    assert spark.read.parquet(args["curated_path"]).count() == 2
    # a new month lands: only its rows are added
    import datetime as dt

    feb_rows = [{"tpep_pickup_datetime": dt.datetime(2025, 2, 2, 9), "tpep_dropoff_datetime": dt.datetime(2025, 2, 2, 9, 20)}]
    L.land_months({(2025, 2): raw_frame(spark, feb_rows)}, raw_root)
    run_incremental_once(spark, **args)
    cur = spark.read.parquet(args["curated_path"])
    assert cur.count() == 3
    assert sorted((r["pickup_month"], r["pickup_day"]) for r in cur.select("pickup_month", "pickup_day").distinct().collect()) == [
        (1, 3), (1, 4), (2, 2)
    ]
    # a month lands again with a day less and a stray row: same days, no duplicates, the lost day goes
    again = [_trip(3), _trip(3), {"tpep_pickup_datetime": dt.datetime(2025, 2, 3, 9), "tpep_dropoff_datetime": dt.datetime(2025, 2, 3, 9, 5)}]
    L.land_months({(2025, 1): raw_frame(spark, again)}, raw_root, overwrite=True)
    run_incremental_once(spark, **args)
    cur = spark.read.parquet(args["curated_path"])
    assert sorted((r["pickup_month"], r["pickup_day"], r["count"]) for r in cur.groupBy("pickup_month", "pickup_day").count().collect()) == [
        (1, 3, 2), (2, 2, 1), (2, 3, 1)
    ]
    days = [d for d in os.listdir(os.path.join(args["rejected_path"], "pickup_year=2025", "pickup_month=1")) if "=" in d]
    assert days == []


def test_incremental_keeps_pickups_months_from_their_file(spark, scratch):
    import datetime as dt

    def at(*ymd):
        return {"tpep_pickup_datetime": dt.datetime(*ymd, 9), "tpep_dropoff_datetime": dt.datetime(*ymd, 9, 20)}

    def days(path):
        rows = spark.read.parquet(path).groupBy("pickup_year", "pickup_month", "pickup_day").count().collect()
        return sorted(tuple(r) for r in rows)

    raw_root = os.path.join(scratch, "raw")
    zones = os.path.join(scratch, "zones")
    zones_frame(spark).coalesce(1).write.option("header", True).csv(zones)
    args = dict(
        raw_root=raw_root,
        zones_path=zones,
        curated_path=os.path.join(scratch, "curated"),
        rejected_path=os.path.join(scratch, "rejected"),
        checkpoint_root=os.path.join(scratch, "ckpt"),
    )
    # wrong clocks: the file of January holds pickups of May and of 2009
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3), at(2025, 5, 2), at(2009, 1, 1)])}, raw_root)
    run_incremental_once(spark, **args)
    assert days(args["curated_path"]) == [(2009, 1, 1, 1), (2025, 1, 3, 1), (2025, 5, 2, 1)]
    # the file of May adds to the day that January's file holds too
    L.land_months({(2025, 5): raw_frame(spark, [at(2025, 5, 2), at(2025, 5, 3)])}, raw_root)
    run_incremental_once(spark, **args)
    assert days(args["curated_path"]) == [(2009, 1, 1, 1), (2025, 1, 3, 1), (2025, 5, 2, 2), (2025, 5, 3, 1)]
    # January lands again without its strays: they go, the trip of May's file stays
    L.land_months({(2025, 1): raw_frame(spark, [_trip(3)])}, raw_root, overwrite=True)
    run_incremental_once(spark, **args)
    assert days(args["curated_path"]) == [(2025, 1, 3, 1), (2025, 5, 2, 1), (2025, 5, 3, 1)]
