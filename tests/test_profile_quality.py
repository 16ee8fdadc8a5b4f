import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cabflow.operators import inspect as I
from cabflow.operators import profile as PR
from cabflow.operators import quality as Q
from tests.test_enrich import TS, raw_frame


def test_duplicates_exact_with_nulls(spark):
    rows = [{}, {}, {}, {"VendorID": 2}, {"passenger_count": None}, {"passenger_count": None}]
    [r] = PR.duplicate_rows(raw_frame(spark, rows)).collect()
    assert r["duplicate_rows"] == 3  # two extra copies of the first, one of the NULL row


def test_duplicates_none(spark):
    [r] = PR.duplicate_rows(raw_frame(spark, [{"VendorID": i} for i in range(5)])).collect()
    assert r["duplicate_rows"] == 0


def test_profile_metrics_edges(spark):
    p = TS(2025, 1, 10, 12, 0, 0)
    rows = [
        {"trip_distance": -1.0, "tip_amount": -0.5},
        {"trip_distance": 0.0, "tpep_dropoff_datetime": p - dt.timedelta(minutes=1), "tpep_pickup_datetime": p},
        {"PULocationID": 0, "DOLocationID": 266, "tpep_pickup_datetime": TS(2024, 12, 31, 23, 0, 0),
         "tpep_dropoff_datetime": TS(2025, 1, 2, 0, 0, 1)},
        {"tpep_pickup_datetime": None},
        {"total_amount": 1500.0, "fare_amount": -2.0},
    ]
    [m] = PR.profile_metrics(raw_frame(spark, rows), 2025, 1).collect()
    assert m["row_count"] == 5 and m["column_count"] == 20
    assert m["negative_trip_distance"] == 1 and m["zero_trip_distance"] == 1
    assert m["negative_tip_amount"] == 1 and m["negative_fare_amount"] == 1
    assert m["dropoff_before_pickup"] == 1 and m["trips_longer_than_24_hours"] == 1
    assert m["rows_outside_expected_month"] == 2  # December row and the NULL pickup
    assert m["null_pickup_datetime"] == 1
    assert m["invalid_pickup_location_ids"] == 1 and m["invalid_dropoff_location_ids"] == 1
    assert m["total_amount_over_1000"] == 1 and m["maximum_total_amount"] == 1500.0
    assert m["minimum_pickup_datetime"] == "2024-12-31T23:00:00"


def test_profile_handles_missing_columns(spark):
    raw = raw_frame(spark, [{}]).drop("tip_amount", "DOLocationID")
    assert PR.missing_required_columns(raw) == ["DOLocationID", "tip_amount"]
    [m] = PR.profile_metrics(raw, 2025, 1).collect()
    assert m["negative_tip_amount"] == 0 and m["invalid_dropoff_location_ids"] == 0


def test_null_counts_only_positive(spark):
    rows = [{"passenger_count": None}, {}, {}, {"passenger_count": None, "RatecodeID": None}]
    got = {r["column_name"]: (r["null_count"], r["null_percentage"]) for r in PR.null_counts(raw_frame(spark, rows)).collect()}
    assert got == {"passenger_count": (2, 50.0), "RatecodeID": (1, 25.0)}


def test_profile_report_shape(spark):
    [doc] = PR.profile_report(raw_frame(spark, [{}, {}]), 2025, 1, "f.parquet").collect()
    assert doc["dataset"]["duplicate_rows"] == 1 and doc["expected_period"]["month"] == 1
    assert doc["schema"]["missing_required_columns"] == [] and doc["null_values"] == {}


def test_exact_quantiles_match_numpy_with_hot_values(spark):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(10, 3, 3000), np.full(2000, 4.25), rng.integers(0, 50, 1000)])
    b = np.round(rng.exponential(2.0, a.size), 2)
    pdf = pd.DataFrame({"a": a, "b": b})
    pdf.loc[::17, "b"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("b", F.when(F.isnan("b"), None).otherwise(F.col("b")))
    got = {(r["column_name"], r["prob"]): r["value"] for r in I.exact_quantiles(df, ["a", "b"], (0.0, 0.25, 0.5, 0.75, 1.0)).collect()}
    for col in ("a", "b"):
        values = pdf[col].dropna().to_numpy()
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert got[(col, p)] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("kept, margin, accuracy", [(200_000, 2.0, 10_000), (40, 2.0, 100), (40, 0.0, 20)])
def test_quantiles_are_exact_however_often_they_are_refined(spark, monkeypatch, kept, margin, accuracy):
    """Narrow brackets, brackets that need a further sketch, and sketches that miss the rank."""
    monkeypatch.setattr(I, "KEPT", kept)
    monkeypatch.setattr(I, "MARGIN", margin)
    monkeypatch.setattr(I, "ACCURACY", accuracy)
    rng = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame(
        {
            "wide": rng.normal(0, 1e6, n),
            "hot": np.where(rng.random(n) < 0.9, 0.0, rng.random(n)),
            "one": np.full(n, 7.0),
            "few": rng.integers(0, 4, n).astype(float),
        }
    )
    df = spark.createDataFrame(pdf).repartition(7)
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)
    found = {(r["column_name"], r["prob"]): r["value"] for r in I.exact_quantiles(df, list(pdf.columns), probs).collect()}
    for col in pdf.columns:
        for p in probs:
            assert found[col, p] == pytest.approx(np.quantile(pdf[col], p), rel=1e-12, abs=1e-12)


def test_quantiles_of_nan_null_and_empty_columns(spark):
    rows = [(float("nan"), None, 1, None), (1.0, None, 2, 5.0), (2.0, None, 4, None), (float("inf"), None, 8, None)]
    df = spark.createDataFrame(rows, "a double, b double, `c.d` int, e double")
    found = {(r["column_name"], r["prob"]): r["value"] for r in I.exact_quantiles(df, df.columns, (0.0, 0.5, 1.0)).collect()}
    assert found["a", 0.0] == 1.0 and found["a", 0.5] == float("inf") and np.isnan(found["a", 1.0])  # NaN is the largest
    assert [found["c.d", p] for p in (0.0, 0.5, 1.0)] == [1.0, 3.0, 8.0]
    assert found["e", 0.5] == 5.0 and ("b", 0.5) not in found
    empty = I.numeric_summary(df.limit(0)).collect()
    assert all(r["count"] == 0 and r["p50"] is None for r in empty) and len(empty) == 4
    assert {r["column_name"]: r["p50"] for r in I.numeric_summary(df).collect()}["b"] is None


def test_quantile_pass_keeps_only_values_near_the_ranks(spark):
    df = spark.range(100_000).select((F.col("id") * 1.0).alias("v"), (F.col("id") % 5 * 1.0).alias("w"))
    kept = I._kept_values(df, {"v": [(24_990.0, 25_010.0)], "w": [(1.0, 1.0)]})
    rows = {(r["column_name"], r["part"]): [0, 0] for r in kept.collect()}
    for r in kept.collect():
        rows[r["column_name"], r["part"]][0] += 1
        rows[r["column_name"], r["part"]][1] += r["n"]
    assert rows["v", 1] == [21, 21] and rows["v", 0] == [1, 24_990] and rows["v", 2] == [1, 74_989]
    assert rows["w", 1] == [1, 20_000]


def test_numeric_summary_columns(spark):
    s = I.numeric_summary(raw_frame(spark, [{"trip_distance": float(i)} for i in range(1, 6)]), ["trip_distance"]).collect()
    [r] = s
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (5, 1.0, 2.0, 3.0, 4.0, 5.0)
    assert r["std"] == pytest.approx(np.std([1, 2, 3, 4, 5], ddof=1), abs=1e-6)


def test_expectations_fail_and_mostly_boundary(spark):
    good = [{"trip_distance": 1.0}] * 999
    rows = good + [{"trip_distance": -1.0}]
    res = {(r["expectation"], r["column_name"]): r for r in Q.raw_expectations(raw_frame(spark, rows)).collect()}
    assert res[(Q.BETWEEN, "trip_distance")]["success"] is True  # exactly 0.999
    rows2 = good[:998] + [{"trip_distance": -1.0}, {"trip_distance": -2.0}]
    res2 = {(r["expectation"], r["column_name"]): r for r in Q.raw_expectations(raw_frame(spark, rows2)).collect()}
    assert res2[(Q.BETWEEN, "trip_distance")]["success"] is False
    bad = Q.raw_expectations(raw_frame(spark, [{"PULocationID": 300, "tpep_dropoff_datetime": None}]))
    res3 = {(r["expectation"], r["column_name"]): r for r in bad.collect()}
    assert res3[(Q.BETWEEN, "PULocationID")]["unexpected_count"] == 1
    assert res3[(Q.NOT_NULL, "tpep_dropoff_datetime")]["success"] is False
    assert Q.gate(bad) is False


def test_expectations_column_order_is_strict(spark):
    raw = raw_frame(spark, [{}])
    reordered = raw.select(*reversed(raw.columns))
    res = {r["expectation"]: r["success"] for r in Q.raw_expectations(reordered).collect() if r["column_name"] is None}
    assert res[Q.COLUMNS_ORDERED] is False and res[Q.ROW_COUNT] is True
    assert Q.gate(Q.raw_expectations(raw)) is True


def test_empty_table_fails_row_count(spark):
    res = {r["expectation"]: r["success"] for r in Q.raw_expectations(raw_frame(spark, [{}]).limit(0)).collect()}
    assert res[Q.ROW_COUNT] is False


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    raw = raw_frame(spark, [{"trip_distance": nan}, {"trip_distance": 7.0}, {"total_amount": nan}, {"trip_distance": nan}])
    [m] = PR.profile_metrics(raw, 2025, 1).collect()
    assert m["maximum_trip_distance"] == 7.0 and m["trip_distance_over_100_miles"] == 0 and m["maximum_total_amount"] == 12.5
    nulls = {r["column_name"]: r["null_count"] for r in PR.null_counts(raw).collect()}
    assert nulls == {"trip_distance": 2, "total_amount": 1}


def test_expectations_fail_on_absent_columns(spark):
    raw = raw_frame(spark, [{}]).drop("PULocationID", "trip_distance")
    res = {(r["expectation"], r["column_name"]): r["success"] for r in Q.raw_expectations(raw).collect()}
    assert res[(Q.BETWEEN, "PULocationID")] is False and res[(Q.BETWEEN, "trip_distance")] is False
    assert res[(Q.BETWEEN, "DOLocationID")] is True


def test_shape(spark):
    [r] = I.shape(raw_frame(spark, [{}, {}, {}])).collect()
    assert (r["row_count"], r["column_count"]) == (3, 20)


def test_kept_values_multiply_no_rows(spark):
    """One row in, one row counted: no generator makes a row of every column of every row."""
    df = spark.range(100).selectExpr("id % 7 as v", "cast(id as double) as w")
    kept = I._kept_values(df, {"v": [(1.0, 2.0), (5.0, 5.0)], "w": [(98.0, 99.0)]})
    assert "Generate" not in kept._jdf.queryExecution().executedPlan().toString()
    rows = {(r["column_name"], r["part"], r["value"]): r["n"] for r in kept.collect()}
    assert rows == {
        ("v", 0, None): 15, ("v", 1, 1.0): 15, ("v", 1, 2.0): 14, ("v", 2, None): 28, ("v", 3, 5.0): 14, ("v", 4, None): 14,
        ("w", 0, None): 98, ("w", 1, 98.0): 1, ("w", 1, 99.0): 1,
    }
