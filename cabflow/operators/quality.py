"""Raw-data expectations (E1-E9) and model not-null tests.

The expectation suite is one aggregation over the raw table; its single row
is unpivoted into one result row per expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow import schema as S

# --- fixed values: expectation type names ----------------------------------
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMNS_ORDERED = "expect_table_columns_to_match_ordered_list"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"

RESULT_SCHEMA = "expectation string, column_name string, success boolean, unexpected_count bigint"


def _outside(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < lo)
    if hi is not None:
        cond = cond | (c > hi)
    return c.isNotNull() & cond


def raw_expectations(
    raw: DataFrame,
    expected_columns: list[str] = S.RAW_COLUMNS,
    location_range: tuple[int, int] = (S.MIN_LOCATION_ID, S.MAX_LOCATION_ID),
    mostly: float = S.DISTANCE_MOSTLY,
) -> DataFrame:
    """One row per expectation: (expectation, column, success, unexpected_count)."""
    lo, hi = location_range  # an expectation on an absent column fails
    columns_match = list(raw.columns) == list(expected_columns)
    have = set(raw.columns)

    def col_or_null(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None)

    dist = col_or_null("trip_distance")
    agg = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(col_or_null("tpep_pickup_datetime").isNull()).alias("null_pickup"),
        F.count_if(col_or_null("tpep_dropoff_datetime").isNull()).alias("null_dropoff"),
        F.count_if(_outside(col_or_null("PULocationID"), lo, hi)).alias("bad_pu"),
        F.count_if(_outside(col_or_null("DOLocationID"), lo, hi)).alias("bad_do"),
        F.count_if(_outside(dist, 0, None)).alias("bad_dist"),
        F.count(dist).alias("dist_non_null"),
    )
    dist_ok = F.when(
        F.col("dist_non_null") == 0, F.lit(True)
    ).otherwise((F.col("dist_non_null") - F.col("bad_dist")) / F.col("dist_non_null") >= mostly)

    def row(kind: str, column: str | None, success: Column, unexpected: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("expectation"),
            F.lit(column).cast("string").alias("column_name"),
            success.alias("success"),
            unexpected.cast("bigint").alias("unexpected_count"),
        )

    zero = F.lit(0)
    there = lambda name: F.lit(name in have)
    rows = F.array(
        row(ROW_COUNT, None, F.col("rows") >= 1, zero),
        row(COLUMNS_ORDERED, None, F.lit(columns_match), zero),
        row(NOT_NULL, "tpep_pickup_datetime", there("tpep_pickup_datetime") & (F.col("null_pickup") == 0), F.col("null_pickup")),
        row(NOT_NULL, "tpep_dropoff_datetime", there("tpep_dropoff_datetime") & (F.col("null_dropoff") == 0), F.col("null_dropoff")),
        row(BETWEEN, "PULocationID", there("PULocationID") & (F.col("bad_pu") == 0), F.col("bad_pu")),
        row(BETWEEN, "DOLocationID", there("DOLocationID") & (F.col("bad_do") == 0), F.col("bad_do")),
        row(BETWEEN, "trip_distance", there("trip_distance") & dist_ok, F.col("bad_dist")),
    )
    return agg.select(F.inline(rows))


def suite_success(results: DataFrame) -> DataFrame:
    """One row: overall success of a result frame (every expectation passed)."""
    return results.agg(F.bool_and("success").alias("success"), F.count(F.lit(1)).alias("expectations"))


def gate(results: DataFrame) -> bool:
    """True when the suite passed; a caller turns False into a failing exit."""
    return bool(suite_success(results).first()["success"])


# --- fixed values: declared not-null tests (model, column) ------------------
NOT_NULL_TESTS = [
    ("stg_trips", "pickup_datetime"),
    ("stg_trips", "dropoff_datetime"),
    ("stg_trips", "pickup_location_id"),
    ("stg_trips", "dropoff_location_id"),
    ("trips_by_borough", "pickup_borough"),
    ("trips_by_hour", "pickup_hour"),
]


# The marts with a test, and the staging column that keys their groups.
MART_KEYS = {"trips_by_borough": "pickup_borough", "trips_by_hour": "pickup_hour"}


def model_tests(stg: DataFrame, tests=NOT_NULL_TESTS) -> DataFrame:
    """(model, column_name, test, failures, status) for each declared not-null test.

    All tests share one pass over the staging view: a mart's key column holds
    one NULL, the group of NULLs, exactly when any staged row has none.
    """
    failures = []
    for model, column in tests:
        null = F.col(column).isNull()
        many = F.max(null.cast("bigint")) if MART_KEYS.get(model) == column else F.count_if(null)
        failures.append(F.coalesce(many, F.lit(0)).cast("bigint").alias(f"{model}.{column}"))
    one = stg.agg(*failures)
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit("not_null").alias("test"),
            F.col(f"`{model}.{column}`").alias("failures"),
        )
        for model, column in tests
    ]
    out = one.select(F.inline(F.array(*rows)))
    return out.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("ERROR"))


def test_summary(results: DataFrame) -> DataFrame:
    """PASS / WARN / ERROR / TOTAL counts of a test run."""
    return results.agg(
        F.count_if(F.col("status") == "PASS").alias("pass_count"),
        F.count_if(F.col("status") == "WARN").alias("warn_count"),
        F.count_if(F.col("status") == "ERROR").alias("error_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
