"""Data-quality profile of a raw trip table.

All scalar metrics come from a single aggregation pass (partial + final hash
aggregate; only one row reaches the driver). NaN counts as missing. Duplicate
detection is the only metric that needs a shuffle of row identities: it counts a
160-bit row fingerprint first and then compares whole rows only for fingerprints
that repeat, by broadcasting those when their counted number is small; beyond
that, whole rows are counted before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow import schema as S
from cabflow.functions import trip_columns as C
from cabflow.session import shared_dir


def _count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def _known(df: DataFrame, name: str) -> Column:
    """The column, with NaN as NULL."""
    c = F.col(name)
    return F.nanvl(c, F.lit(None)) if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)) else c


def profile_metrics(
    raw: DataFrame,
    expected_year: int,
    expected_month: int,
    location_range: tuple[int, int] = (S.MIN_LOCATION_ID, S.MAX_LOCATION_ID),
) -> DataFrame:
    """One row with the scalar profile metrics (flat names)."""
    cols = set(raw.columns)
    pickup = C.coerce_timestamp("tpep_pickup_datetime") if "tpep_pickup_datetime" in cols else F.lit(None).cast("timestamp_ntz")
    dropoff = C.coerce_timestamp("tpep_dropoff_datetime") if "tpep_dropoff_datetime" in cols else F.lit(None).cast("timestamp_ntz")
    minutes = (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / 60.0
    inside = (F.year(pickup) == expected_year) & (F.month(pickup) == expected_month)

    def num(name: str) -> Column:
        return _known(raw, name) if name in cols else F.lit(None).cast("double")

    dist, fare, tip, total = num("trip_distance"), num("fare_amount"), num("tip_amount"), num("total_amount")
    pu, do = num("PULocationID"), num("DOLocationID")
    outside = lambda c: (c < location_range[0]) | (c > location_range[1])
    return raw.agg(
        F.lit(expected_year).alias("expected_year"),
        F.lit(expected_month).alias("expected_month"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(raw.columns)).cast("bigint").alias("column_count"),
        F.count_if(pickup.isNull()).alias("null_pickup_datetime"),
        F.count_if(dropoff.isNull()).alias("null_dropoff_datetime"),
        _count_if(minutes < 0).alias("dropoff_before_pickup"),
        _count_if(minutes == 0).alias("zero_duration_trips"),
        _count_if(minutes > S.MAX_DURATION_MINUTES).alias("trips_longer_than_24_hours"),
        F.count_if(~F.coalesce(inside, F.lit(False))).alias("rows_outside_expected_month"),
        C.iso_seconds(F.min(pickup)).alias("minimum_pickup_datetime"),
        C.iso_seconds(F.max(pickup)).alias("maximum_pickup_datetime"),
        _count_if(dist < 0).alias("negative_trip_distance"),
        _count_if(dist == 0).alias("zero_trip_distance"),
        _count_if(dist > S.MAX_DISTANCE_MILES).alias("trip_distance_over_100_miles"),
        F.max(dist).alias("maximum_trip_distance"),
        _count_if(fare < 0).alias("negative_fare_amount"),
        _count_if(tip < 0).alias("negative_tip_amount"),
        _count_if(total < 0).alias("negative_total_amount"),
        _count_if(total > S.MAX_TOTAL_AMOUNT).alias("total_amount_over_1000"),
        F.max(total).alias("maximum_total_amount"),
        _count_if(outside(pu)).alias("invalid_pickup_location_ids"),
        _count_if(outside(do)).alias("invalid_dropoff_location_ids"),
    )


def null_counts(raw: DataFrame) -> DataFrame:
    """(column_name, null_count, null_percentage) for every column with a NULL.

    One aggregation over the data; the unpivot runs on its single row.
    """
    counts = raw.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_known(raw, c).isNull()).alias(c) for c in raw.columns],
    )
    long = counts.unpivot("__rows", raw.columns, "column_name", "null_count")
    return long.filter(F.col("null_count") > 0).select(
        "column_name",
        "null_count",
        F.round(F.col("null_count") / F.col("__rows") * 100, 2).alias("null_percentage"),
    )


def _fingerprint(columns) -> dict[str, Column]:
    """What stands for a row: two 64-bit hashes, one of 32, and which columns are NULL.

    The hashes pass over NULLs, so (1, NULL) and (NULL, 1) differ by the last only.
    """
    cols = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return {"h1": F.xxhash64(*cols), "h2": F.hash(*cols), "h3": F.xxhash64(F.lit("salt"), *cols), "h4": F.xxhash64(nulls)}


def duplicate_rows(raw: DataFrame) -> DataFrame:
    """One row: rows that repeat an earlier identical row (all columns).

    Rows are counted by fingerprint: equal ones in each task first, so that a row copied
    a billion times is one row a task, and only fingerprints and counts are shuffled,
    also where every row repeats. A further hash, over the columns in reverse, is
    carried along as least and greatest value; fingerprints for which these differ
    belong to different rows, and only their rows are grouped by all columns.
    """
    cols = raw.columns
    shared_dir(raw.sparkSession)  # checkpoint() needs the shared folder registered
    prints = _fingerprint(cols)
    witness = F.xxhash64(F.lit("witness"), *[F.col(f"`{c}`") for c in reversed(cols)])
    groups = (
        raw.select(*[c.alias(n) for n, c in prints.items()], witness.alias("w"))
        .groupBy(*prints)
        .agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("low"), F.max("w").alias("high"))
        .filter("n > 1")
    )
    split = F.col("low") != F.col("high")
    totals = groups.agg(
        F.coalesce(F.sum(F.when(~split, F.col("n") - 1)), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count_if(split).alias("shared"),
    ).checkpoint(eager=True)  # one row
    if not totals.first()["shared"]:
        return totals.select("duplicate_rows")
    shared = groups.filter(split).select(*[F.col(n).alias(f"__{n}") for n in prints])
    same = [c == F.col(f"__{n}") for n, c in prints.items()]
    rows = raw.join(shared, same, "left_semi").groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("n"))
    rest = rows.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("more"))
    return totals.join(rest).select((F.col("duplicate_rows") + F.col("more")).alias("duplicate_rows"))


def missing_required_columns(raw: DataFrame) -> list[str]:
    return [c for c in S.PROFILE_REQUIRED_COLUMNS if c not in raw.columns]


def input_size_mb(spark: SparkSession, path: str) -> DataFrame:
    """Total size in MB (2 dp) of the Parquet files below ``path``; no content is read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .load(path).select("length")
    )
    return files.agg(F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024), 2).alias("file_size_mb"))


def profile_report(
    raw: DataFrame, expected_year: int, expected_month: int, file_label: str | None = None, path: str | None = None
) -> DataFrame:
    """The nested profile document as one row (sections as structs); ``path`` gives the size of its files.

    Built from the three distributed aggregations above; only their one-row
    results are combined, by joining single rows, never by collecting data.
    """
    m = profile_metrics(raw, expected_year, expected_month)
    dup = duplicate_rows(raw)
    nulls = null_counts(raw).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    F.col("column_name"),
                    F.struct(F.col("null_count").alias("count"), F.col("null_percentage").alias("percentage")),
                )
            )
        ).alias("null_values")
    )
    missing = missing_required_columns(raw)
    one = F.lit(1).alias("__one")
    size = input_size_mb(raw.sparkSession, path) if path else raw.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("file_size_mb")
    )
    doc = m.select("*", one).join(dup.select("*", one), "__one").join(nulls.select("*", one), "__one")
    doc = doc.join(size.select("*", one), "__one")
    return doc.select(
        F.lit(file_label).alias("file"),
        "file_size_mb",
        F.struct(F.col("expected_year").alias("year"), F.col("expected_month").alias("month")).alias("expected_period"),
        F.struct("row_count", "column_count", "duplicate_rows").alias("dataset"),
        F.struct(
            F.array(*[F.lit(c) for c in raw.columns]).alias("columns"),
            F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_required_columns"),
        ).alias("schema"),
        F.col("null_values"),
        F.struct(
            "null_pickup_datetime",
            "null_dropoff_datetime",
            "dropoff_before_pickup",
            "zero_duration_trips",
            "trips_longer_than_24_hours",
            "rows_outside_expected_month",
            "minimum_pickup_datetime",
            "maximum_pickup_datetime",
        ).alias("date_quality"),
        F.struct(
            "negative_trip_distance",
            "zero_trip_distance",
            "trip_distance_over_100_miles",
            "maximum_trip_distance",
        ).alias("distance_quality"),
        F.struct(
            "negative_fare_amount",
            "negative_tip_amount",
            "negative_total_amount",
            "total_amount_over_1000",
            "maximum_total_amount",
        ).alias("amount_quality"),
        F.struct("invalid_pickup_location_ids", "invalid_dropoff_location_ids").alias("location_quality"),
    )
