"""Physical-plan shape: pushdown, pruning, broadcast, top-k, no cartesian products."""

from cabflow.plans import analytics as A
from cabflow.plans import models as M
from cabflow.plans.registry import _fx
from cabflow.sources import period as P
from tests.conftest import SF_SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_mart_plan_prunes_pushes_and_broadcasts(spark):
    fx = _fx(spark, SF_SMALL)
    plan = plan_of(M.trips_by_borough(fx.stg))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan
    # only the lineitem columns the mart needs reach the scan
    scan = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "l_discount" not in scan and "l_suppkey" not in scan and "l_linestatus" not in scan


def test_partial_aggregation(spark):
    plan = plan_of(A.trips_per_borough(_fx(spark, SF_SMALL).curated))
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_top_k_is_take_ordered(spark):
    plan = plan_of(A.top_rejected_by_amount(_fx(spark, SF_SMALL).rejected, 50))
    assert "TakeOrderedAndProject" in plan


def test_raw_month_pruning_reaches_partition_filters(spark, scratch):
    from tests.test_enrich import TS, raw_frame
    from cabflow.sources.landing import land_months

    rows = [{"tpep_pickup_datetime": TS(2025, m, 2, 8, 0, 0), "tpep_dropoff_datetime": TS(2025, m, 2, 8, 5, 0)} for m in range(1, 7)]
    land_months({(2025, m): raw_frame(spark, rows[m - 1 : m]) for m in range(1, 7)}, scratch + "/raw")
    from cabflow.sources.raw import read_raw_trips

    pruned = P.prune_raw_months(read_raw_trips(spark, scratch + "/raw"), P.Period.parse("10/03/2025", "20/03/2025"))
    plan = plan_of(pruned)
    assert "PartitionFilters: [isnotnull(year" in plan
    assert sorted(r["month"] for r in pruned.select("month").distinct().collect()) == [2, 3, 4]


def test_coverage_range_reaches_the_scan(spark, scratch):
    from tests.test_enrich import raw_frame

    raw_frame(spark, [{}]).write.parquet(scratch + "/t")
    plan = plan_of(P.period_coverage(spark.read.parquet(scratch + "/t"), P.Period.parse("10/03/2025", "20/04/2025")))
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2025-03-01T00:00), Less" in pushed
    assert ">= 2025-03-01 00:00:00" in plan and "< 2025-05-01 00:00:00" in plan


def test_duplicates_shuffle_fingerprints_only(spark, monkeypatch):
    from cabflow.operators import profile as PR
    from tests.test_enrich import raw_frame

    raw = raw_frame(spark, [{"VendorID": i % 3} for i in range(12)] + [{"VendorID": 50 + i} for i in range(4)])
    groups = []
    done = type(raw).checkpoint
    monkeypatch.setattr(type(raw), "checkpoint", lambda self, *a, **k: groups.append(self) or done(self, *a, **k))
    for rows, repeats in ((raw, 9), (raw.unionByName(raw), 25)):  # also where every month landed twice
        assert PR.duplicate_rows(rows).first()[0] == repeats
        plan = plan_of(groups[-1]).split("== Initial Plan ==")[0]
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert len(exchanges) == 1 and "VendorID" not in exchanges[0]
        below = plan.splitlines()[plan.splitlines().index(exchanges[0]) + 1]
        assert "partial_count" in below  # equal rows are counted in each task first


def test_duplicates_stay_exact_when_fingerprints_collide(spark, monkeypatch):
    from cabflow.operators import profile as PR
    from tests.test_enrich import raw_frame

    same = [{"fare_amount": 1.0, "extra": None}] * 2 + [{"fare_amount": None, "extra": 1.0}] * 3
    assert PR.duplicate_rows(raw_frame(spark, same)).first()[0] == 3  # NULLs change places
    honest = PR._fingerprint
    one = lambda cols: {n: c * 0 for n, c in honest(cols).items()}
    monkeypatch.setattr(PR, "_fingerprint", one)
    raw = raw_frame(spark, [{"VendorID": i % 3} for i in range(12)] + [{"VendorID": 50 + i} for i in range(4)])
    assert PR.duplicate_rows(raw).first()[0] == 9
    assert PR.duplicate_rows(raw_frame(spark, [{}])).first()[0] == 0
    assert PR.duplicate_rows(raw_frame(spark, [{}]).limit(0)).first()[0] == 0
