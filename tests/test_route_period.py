import datetime as dt

import pytest

from cabflow.operators import enrich as E
from cabflow.operators import route as R
from cabflow.sources import period as P
from tests.test_enrich import TS, raw_frame, zones_frame


def test_parse_strict_and_ordered():
    p = P.Period.parse("15/03/2025", "10/05/2025")
    assert (p.start, p.end) == (dt.date(2025, 3, 15), dt.date(2025, 5, 10))
    assert p.month_keys() == (202503, 202505)
    with pytest.raises(ValueError):
        P.Period.parse("2025-03-15", "2025-05-10")
    with pytest.raises(ValueError):
        P.Period.parse("10/05/2025", "15/03/2025")
    with pytest.raises(ValueError):
        P.Period.parse("01/01/2008", "31/01/2008")


def test_months_across_years_and_widening():
    p = P.Period.parse("20/11/2024", "05/02/2025")
    assert p.month_keys() == (202411, 202502)
    assert p.month_keys(1) == (202410, 202503)


def test_month_plan_matches_python(spark):
    p = P.Period.parse("20/11/2024", "05/02/2025")
    got = sorted(tuple(r) for r in P.month_plan(spark, p).collect())
    assert got == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def test_period_filter_inclusive_and_routing_with_null_flag(spark):
    rows = [
        {"tpep_pickup_datetime": TS(2025, 1, 1, 0, 0, 0), "tpep_dropoff_datetime": TS(2025, 1, 1, 0, 5, 0)},
        {"tpep_pickup_datetime": TS(2025, 1, 31, 23, 59, 59), "tpep_dropoff_datetime": TS(2025, 2, 1, 0, 5, 0)},
        {"tpep_pickup_datetime": TS(2024, 12, 31, 23, 0, 0), "tpep_dropoff_datetime": TS(2024, 12, 31, 23, 5, 0)},
        {"tpep_pickup_datetime": TS(2025, 1, 10, 9, 0, 0), "tpep_dropoff_datetime": None},
        {"tpep_pickup_datetime": TS(2025, 1, 10, 9, 0, 0), "tpep_dropoff_datetime": TS(2025, 1, 10, 9, 0, 0)},
        {"tpep_pickup_datetime": None},
    ]
    period = P.Period.parse("01/01/2025", "31/01/2025")
    enriched = E.enrich(raw_frame(spark, rows), zones_frame(spark))
    routed = R.route(enriched, period)
    assert routed.in_period.count() == 4
    assert routed.curated.count() == 2
    assert routed.rejected.count() == 2  # zero duration + NULL flag
    [rec] = R.reconciliation(enriched, period).collect()
    assert rec["source_rows"] == 6 and rec["out_of_period_rows"] == 2
    assert rec["curated_rows"] + rec["rejected_rows"] == rec["in_period_rows"] == 4
    assert rec["null_flag_rows"] == 1 and rec["loss_rows"] == 0 and rec["reconciled"] is True


def test_period_filter_reaches_scan(spark, scratch):
    raw = raw_frame(spark, [{}])
    raw.write.parquet(scratch + "/t")
    df = E.enrich(spark.read.parquet(scratch + "/t"), zones_frame(spark))
    plan = R.route(df, P.Period.parse("01/01/2025", "31/01/2025")).curated._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2025-01-01T00:00), Less" in plan.split("PushedFilters: [")[1]


def test_coverage_counts_missing_months_as_zero(spark):
    rows = [{"tpep_pickup_datetime": TS(2025, m, 3, 8, 0, 0), "tpep_dropoff_datetime": TS(2025, m, 3, 8, 9, 0)} for m in (1, 1, 3)]
    cov = P.period_coverage(raw_frame(spark, rows), P.Period.parse("01/12/2024", "28/03/2025"))
    assert sorted(tuple(r) for r in cov.collect()) == [(2024, 12, 0), (2025, 1, 2), (2025, 2, 0), (2025, 3, 1)]
