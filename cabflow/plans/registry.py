"""Registered queries over the shared test tables, each with its DuckDB twin.

``QUERIES[name] = (build, sql)`` where ``build(spark, sf_dir)`` returns a
lazy DataFrame and ``sql`` is the oracle statement (``None`` for rows-only
checks). The trip fixture is the projection of ``lineitem`` described in
``cabflow.sources.fixtures``; every query runs over the whole table.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow import oracle_sql as O
from cabflow import schema as S
from cabflow.operators import enrich as E
from cabflow.operators import inspect as I
from cabflow.operators import profile as PR
from cabflow.operators import quality as Q
from cabflow.operators import route as R
from cabflow.plans import analytics as A
from cabflow.plans import models as M
from cabflow.session import shared_path
from cabflow.sources import fixtures as FX
from cabflow.sources import period as P
from cabflow.sources import raw as RAW

# Parameters of the fixture runs. The fixture's pickups span 1995-01-02 ..
# 2001-11-04, so the raw feed's 2009 floor does not apply to it.
FIXTURE_MIN_YEAR = 1992
FULL_PERIOD = P.Period.parse("01/01/1995", "31/12/2001", min_year=FIXTURE_MIN_YEAR)
NARROW_PERIOD = P.Period.parse("15/03/1997", "14/06/1998", min_year=FIXTURE_MIN_YEAR)
COVERAGE_PERIOD = P.Period.parse("01/06/2001", "31/03/2002", min_year=FIXTURE_MIN_YEAR)
EXPECTED_YEAR, EXPECTED_MONTH = 1997, 1
RUN_TS = dt.datetime(2025, 2, 1, 6, 0, 0, tzinfo=dt.timezone.utc)


class Fixture:
    """Lazy frames of one fixture run (nothing executes until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str, period: P.Period = FULL_PERIOD):
        self.spark, self.sf_dir, self.period = spark, sf_dir, period

    @cached_property
    def raw(self) -> DataFrame:
        return FX.fixture_trips(self.spark, self.sf_dir)

    @cached_property
    def zones(self) -> DataFrame:
        return FX.fixture_zones(self.spark, self.sf_dir)

    @cached_property
    def enriched(self) -> DataFrame:
        return E.enrich(self.raw, self.zones, run_ts=RUN_TS)

    @cached_property
    def routed(self) -> R.Routed:
        return R.route(self.enriched, self.period)

    @property
    def curated(self) -> DataFrame:
        return self.routed.curated

    @property
    def rejected(self) -> DataFrame:
        return self.routed.rejected

    @cached_property
    def stg(self) -> DataFrame:
        return M.stg_trips(self.curated)

    def scratch(self, name: str) -> str:
        """Per-session and per-input folder under the shared directory for written fixtures."""
        key = hashlib.sha1(os.path.abspath(self.sf_dir).encode()).hexdigest()[:12]
        return shared_path(self.spark, "fixtures", self.spark.sparkContext.applicationId, key, name)


_FIXTURES: dict[tuple, Fixture] = {}


def _fx(spark, sf_dir, period=FULL_PERIOD) -> Fixture:
    """The fixture frames of one input, built once per session.

    DataFrames are immutable lazy plans, so reusing them only saves plan
    construction and the one-off lookup probe; every action still reads the
    tables.
    """
    key = (spark.sparkContext.applicationId, id(spark), os.path.abspath(sf_dir), period)
    if key not in _FIXTURES:
        _FIXTURES[key] = Fixture(spark, sf_dir, period)
    return _FIXTURES[key]


def _no_ts(df: DataFrame) -> DataFrame:
    return df.drop("processing_timestamp")


QUERIES: dict[str, tuple] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return deco


def _cols(names) -> str:
    return ", ".join(names)


ENRICHED_NO_TS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "rate_code_id", "store_and_fwd_flag", "pickup_location_id", "dropoff_location_id",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "trip_duration_minutes", "pickup_date", "pickup_year", "pickup_month",
    "pickup_day", "pickup_hour", "pickup_weekday", "is_weekend", "is_peak_hour",
    "average_speed_mph", "is_refund_or_reversal", "is_anomalous_trip", "pickup_borough",
    "pickup_zone", "pickup_service_zone", "dropoff_borough", "dropoff_zone", "dropoff_service_zone",
]

# ---------------------------------------------------------------- marts (A1-A3)


@query(
    "trips_by_borough",
    O.with_routed(
        FULL_PERIOD,
        """SELECT pickup_borough, COUNT(*) AS trip_count,
       ROUND(AVG(total_amount), 2) AS avg_total_amount,
       ROUND(AVG(trip_distance), 2) AS avg_trip_distance
FROM stg_trips GROUP BY pickup_borough""",
    ),
)
def q_trips_by_borough(spark, sf_dir):
    return M.trips_by_borough(_fx(spark, sf_dir).stg)


@query(
    "trips_by_hour",
    O.with_routed(
        FULL_PERIOD,
        """SELECT pickup_hour, COUNT(*) AS trip_count,
       ROUND(AVG(total_amount), 2) AS avg_total_amount,
       ROUND(AVG(trip_distance), 2) AS avg_trip_distance
FROM stg_trips GROUP BY pickup_hour ORDER BY pickup_hour""",
    ),
)
def q_trips_by_hour(spark, sf_dir):
    return M.trips_by_hour(_fx(spark, sf_dir).stg)


@query(
    "top_pickup_zones",
    O.with_routed(
        FULL_PERIOD,
        """SELECT pickup_zone, pickup_borough, COUNT(*) AS trip_count,
       ROUND(AVG(total_amount), 2) AS avg_total_amount
FROM stg_trips GROUP BY pickup_zone, pickup_borough
ORDER BY trip_count DESC, pickup_zone ASC NULLS FIRST, pickup_borough ASC NULLS FIRST""",
    ),
)
def q_top_pickup_zones(spark, sf_dir):
    return M.top_pickup_zones(_fx(spark, sf_dir).stg)


# ------------------------------------------------------- ad-hoc SQL


@query("total_trips", O.with_routed(FULL_PERIOD, "SELECT COUNT(*) AS total_trips FROM curated"))
def q_total_trips(spark, sf_dir):
    return A.total_trips(_fx(spark, sf_dir).curated)


@query(
    "trips_per_borough",
    O.with_routed(
        FULL_PERIOD,
        "SELECT pickup_borough, COUNT(*) AS trip_count FROM curated GROUP BY pickup_borough",
    ),
)
def q_trips_per_borough(spark, sf_dir):
    return A.trips_per_borough(_fx(spark, sf_dir).curated)


@query(
    "trips_per_hour",
    O.with_routed(FULL_PERIOD, "SELECT pickup_hour, COUNT(*) AS trip_count FROM curated GROUP BY pickup_hour"),
)
def q_trips_per_hour(spark, sf_dir):
    return A.trips_per_hour(_fx(spark, sf_dir).curated)


@query(
    "avg_total_per_borough",
    O.with_routed(
        FULL_PERIOD,
        "SELECT pickup_borough, ROUND(AVG(total_amount), 2) AS avg_total_amount FROM curated GROUP BY pickup_borough",
    ),
)
def q_avg_total_per_borough(spark, sf_dir):
    return A.avg_total_per_borough(_fx(spark, sf_dir).curated)


@query(
    "avg_distance_per_borough",
    O.with_routed(
        FULL_PERIOD,
        "SELECT pickup_borough, ROUND(AVG(trip_distance), 2) AS avg_trip_distance FROM curated GROUP BY pickup_borough",
    ),
)
def q_avg_distance_per_borough(spark, sf_dir):
    return A.avg_distance_per_borough(_fx(spark, sf_dir).curated)


@query(
    "trips_by_peak_hour",
    O.with_routed(FULL_PERIOD, "SELECT is_peak_hour, COUNT(*) AS trip_count FROM curated GROUP BY is_peak_hour"),
)
def q_trips_by_peak_hour(spark, sf_dir):
    return A.trips_by_peak_hour(_fx(spark, sf_dir).curated)


@query(
    "top10_pickup_zones",
    O.with_routed(
        FULL_PERIOD,
        """SELECT pickup_zone, COUNT(*) AS trip_count FROM curated GROUP BY pickup_zone
ORDER BY trip_count DESC, pickup_zone ASC NULLS FIRST LIMIT 10""",
    ),
)
def q_top10_pickup_zones(spark, sf_dir):
    return A.top_zones(_fx(spark, sf_dir).curated, "pickup", 10)


@query(
    "top10_dropoff_zones",
    O.with_routed(
        FULL_PERIOD,
        """SELECT dropoff_zone, COUNT(*) AS trip_count FROM curated GROUP BY dropoff_zone
ORDER BY trip_count DESC, dropoff_zone ASC NULLS FIRST LIMIT 10""",
    ),
)
def q_top10_dropoff_zones(spark, sf_dir):
    return A.top_zones(_fx(spark, sf_dir).curated, "dropoff", 10)


@query(
    "top50_rejected_by_amount",
    O.with_routed(
        FULL_PERIOD,
        """SELECT trip_distance, trip_duration_minutes, total_amount, pickup_zone, dropoff_zone
FROM rejected
ORDER BY total_amount DESC NULLS LAST, trip_distance DESC NULLS LAST,
         trip_duration_minutes DESC NULLS LAST, pickup_zone ASC NULLS FIRST, dropoff_zone ASC NULLS FIRST
LIMIT 50""",
    ),
)
def q_top50_rejected(spark, sf_dir):
    return A.top_rejected_by_amount(_fx(spark, sf_dir).rejected, 50)


@query(
    "curated_date_range",
    O.with_routed(
        FULL_PERIOD,
        """SELECT MIN(pickup_datetime) AS min_pickup_date, MAX(pickup_datetime) AS max_pickup_date,
       COUNT(*) AS trip_count FROM curated""",
    ),
)
def q_curated_date_range(spark, sf_dir):
    return A.curated_date_range(_fx(spark, sf_dir).curated)


@query(
    "monthly_trip_counts",
    O.with_routed(
        FULL_PERIOD,
        """SELECT pickup_year, pickup_month, COUNT(*) AS trip_count FROM curated
GROUP BY pickup_year, pickup_month ORDER BY pickup_year, pickup_month""",
    ),
)
def q_monthly_trip_counts(spark, sf_dir):
    return A.monthly_trip_counts(_fx(spark, sf_dir).curated)


@query("rejected_count", O.with_routed(FULL_PERIOD, "SELECT COUNT(*) AS rejected_count FROM rejected"))
def q_rejected_count(spark, sf_dir):
    return A.rejected_count(_fx(spark, sf_dir).rejected)


def _reconciliation_sql(period: P.Period) -> str:
    inside = f"coalesce(CAST(pickup_datetime AS DATE) BETWEEN DATE '{period.start}' AND DATE '{period.end}', false)"
    return O.with_enriched(
        f"""SELECT *, in_period_rows - curated_rows - rejected_rows AS loss_rows,
       in_period_rows - curated_rows - rejected_rows = 0 AS reconciled
FROM (SELECT COUNT(*) AS source_rows,
        count_if(NOT {inside}) AS out_of_period_rows,
        count_if({inside}) AS in_period_rows,
        count_if({inside} AND NOT coalesce(is_anomalous_trip, true)) AS curated_rows,
        count_if({inside} AND coalesce(is_anomalous_trip, true)) AS rejected_rows,
        count_if({inside} AND is_anomalous_trip IS NULL) AS null_flag_rows
      FROM enriched)"""
    )


@query("reconciliation", _reconciliation_sql(FULL_PERIOD))
def q_reconciliation(spark, sf_dir):
    return R.reconciliation(_fx(spark, sf_dir).enriched, FULL_PERIOD)


@query("reconciliation_narrow_period", _reconciliation_sql(NARROW_PERIOD))
def q_reconciliation_narrow(spark, sf_dir):
    return R.reconciliation(_fx(spark, sf_dir).enriched, NARROW_PERIOD)


# ------------------------------------------------- projections, joins, routing


@query("standardized_trips", O.with_raw(f"SELECT {_cols(f'{k} AS {S.RENAMES[k]}' if k in S.RENAMES else k for k in S.RAW_COLUMNS)} FROM raw_trips"))
def q_standardized(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return E.coerce_datetimes(E.standardize(fx.raw))


_METRIC_COLS = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "trip_distance",
    "fare_amount", "total_amount", "trip_duration_minutes", "pickup_date", "pickup_year",
    "pickup_month", "pickup_day", "pickup_hour", "pickup_weekday", "is_weekend", "is_peak_hour",
    "average_speed_mph", "is_refund_or_reversal", "is_anomalous_trip",
]


@query("trip_metrics", O.with_enriched(f"SELECT {_cols(_METRIC_COLS)} FROM flags"))
def q_trip_metrics(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    trips = E.coerce_datetimes(E.standardize(fx.raw))
    return E.add_trip_metrics(trips, RUN_TS).select(*_METRIC_COLS)


_ZONE_COLS = [
    "pickup_location_id", "dropoff_location_id", "pickup_borough", "pickup_zone",
    "pickup_service_zone", "dropoff_borough", "dropoff_zone", "dropoff_service_zone",
]


@query("enriched_zones", O.with_enriched(f"SELECT {_cols(_ZONE_COLS)} FROM enriched"))
def q_enriched_zones(spark, sf_dir):
    return _fx(spark, sf_dir).enriched.select(*_ZONE_COLS)


@query("stg_trips", O.with_routed(FULL_PERIOD, "SELECT * FROM stg_trips"))
def q_stg_trips(spark, sf_dir):
    return _no_ts(_fx(spark, sf_dir).stg)


@query("rejected_trips", O.with_routed(FULL_PERIOD, f"SELECT {_cols(ENRICHED_NO_TS)} FROM rejected"))
def q_rejected_trips(spark, sf_dir):
    return _fx(spark, sf_dir).rejected.select(*ENRICHED_NO_TS)


@query(
    "route_split_by_month",
    O.with_routed(
        FULL_PERIOD,
        """SELECT pickup_year, pickup_month,
       count_if(NOT coalesce(is_anomalous_trip, true)) AS curated_rows,
       count_if(coalesce(is_anomalous_trip, true)) AS rejected_rows,
       count_if(is_anomalous_trip IS NULL) AS null_flag_rows
FROM in_period GROUP BY pickup_year, pickup_month""",
    ),
)
def q_route_split(spark, sf_dir):
    routed = _fx(spark, sf_dir).routed
    rej = F.coalesce(F.col("is_anomalous_trip"), F.lit(True))
    return routed.in_period.groupBy("pickup_year", "pickup_month").agg(
        F.count_if(~rej).alias("curated_rows"),
        F.count_if(rej).alias("rejected_rows"),
        F.count_if(F.col("is_anomalous_trip").isNull()).alias("null_flag_rows"),
    )


@query(
    "period_filter_days",
    O.with_routed(
        NARROW_PERIOD,
        "SELECT pickup_date, COUNT(*) AS trip_count FROM in_period GROUP BY pickup_date",
    ),
)
def q_period_filter_days(spark, sf_dir):
    fx = _fx(spark, sf_dir, NARROW_PERIOD)
    return fx.routed.in_period.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trip_count"))


@query(
    "enriched_preview",
    O.with_enriched(
        f"SELECT {_cols(S.PREVIEW_COLUMNS)} FROM enriched ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in S.PREVIEW_COLUMNS)
        + " LIMIT 5"
    ),
)
def q_enriched_preview(spark, sf_dir):
    return A.enriched_preview(_fx(spark, sf_dir).enriched, 5)


@query(
    "zone_key_duplicates",
    O.with_zones("SELECT LocationID, COUNT(*) AS key_count FROM zones GROUP BY LocationID HAVING COUNT(*) > 1"),
)
def q_zone_key_duplicates(spark, sf_dir):
    return E.duplicate_zone_keys(_fx(spark, sf_dir).zones)


@query(
    "zone_key_duplicates_doubled",
    O.with_zones(
        "SELECT LocationID, COUNT(*) AS key_count FROM (SELECT * FROM zones UNION ALL SELECT * FROM zones WHERE LocationID % 2 = 0) GROUP BY LocationID HAVING COUNT(*) > 1"
    ),
)
def q_zone_key_duplicates_doubled(spark, sf_dir):
    """Every second zone twice: the guard names each of them."""
    zones = _fx(spark, sf_dir).zones
    return E.duplicate_zone_keys(zones.unionByName(zones.filter("LocationID % 2 = 0")))


@query(
    "unmatched_zones",
    O.with_enriched(
        """SELECT count_if(pickup_zone IS NULL) AS missing_pickup_zones,
       count_if(dropoff_zone IS NULL) AS missing_dropoff_zones FROM enriched"""
    ),
)
def q_unmatched_zones(spark, sf_dir):
    return A.unmatched_zone_counts(_fx(spark, sf_dir).enriched)


@query(
    "run_summary",
    O.with_enriched(
        """SELECT COUNT(*) AS transformed_rows, CAST(39 AS BIGINT) AS final_column_count,
       count_if(is_anomalous_trip) AS anomalous_rows FROM enriched"""
    ),
)
def q_run_summary(spark, sf_dir):
    return A.run_summary(_fx(spark, sf_dir).enriched)


# ------------------------------------------- sources, landing, period planning


def _label(shift_days: int) -> tuple:
    """File month of a fixture row: that of its pickup, ``shift_days`` earlier."""
    day = F.date_sub(F.to_date("tpep_pickup_datetime"), shift_days)
    return F.year(day), F.month(day)


def _land_fixture(fx: Fixture, shift_days: int = 0) -> str:
    """Land the whole fixture into ``year=/month=`` once per session and input."""
    from cabflow.sources.landing import land_labelled

    name = f"raw_trips_{shift_days}"
    if name not in fx.__dict__:
        root = fx.scratch(name)
        land_labelled(fx.raw, root, *_label(shift_days))
        fx.__dict__[name] = root
    return fx.__dict__[name]


def _zones_csv(fx: Fixture) -> str:
    """The fixture zone lookup written once as a CSV file with a header."""
    if "zones_csv" not in fx.__dict__:
        path = fx.scratch("zones_csv")
        fx.zones.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
        fx.__dict__["zones_csv"] = path
    return fx.__dict__["zones_csv"]


_MONTH_SQL = """SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
       CAST(month(tpep_pickup_datetime) AS INTEGER) AS month, COUNT(*) AS row_count
FROM raw_trips {where} GROUP BY ALL"""


@query("raw_layout_month_counts", O.with_raw(_MONTH_SQL.format(where="")))
def q_raw_layout_month_counts(spark, sf_dir):
    """Landing (S6) then a partition-discovering scan (S1), counted per month."""
    fx = _fx(spark, sf_dir)
    raw = RAW.read_raw_trips(spark, _land_fixture(fx))
    return raw.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "raw_month_quality",
    O.with_raw(
        """SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, COUNT(*) AS row_count,
       count_if(month(tpep_pickup_datetime) <> month(d)) AS stray_rows
FROM (SELECT *, CAST(tpep_pickup_datetime AS DATE) - 3 AS d FROM raw_trips) GROUP BY ALL"""
    ),
)
def q_raw_month_quality(spark, sf_dir):
    """Files labelled three days early keep their rows of the next month."""
    raw = RAW.read_raw_trips(spark, _land_fixture(_fx(spark, sf_dir), 3))
    stray = F.month("tpep_pickup_datetime") != F.col("month").cast("int")
    return raw.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(stray).alias("stray_rows")
    )


@query(
    "month_index_days",
    O.with_raw(
        """SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(tpep_pickup_datetime AS DATE) AS day, COUNT(*) AS row_count
FROM (SELECT *, CAST(tpep_pickup_datetime AS DATE) - 75 AS d FROM raw_trips) GROUP BY ALL"""
    ),
)
def q_month_index_days(spark, sf_dir):
    """The written month index: days and row counts of files labelled 75 days early."""
    from cabflow.sources import month_index as MI

    root = _land_fixture(_fx(spark, sf_dir), 75)
    MI.refresh(spark, root)
    rows = spark.read.parquet(MI.index_path(root)).select("label", F.explode("days").alias("d"))
    return rows.select(
        F.floor(F.col("label") / 12).cast("int").alias("year"),
        (F.col("label") % 12 + 1).cast("int").alias("month"),
        F.col("d.day").alias("day"),
        F.col("d.row_count").alias("row_count"),
    )


_lo, _hi = NARROW_PERIOD.month_keys(1)


@query(
    "raw_pruned_month_counts",
    O.with_raw(
        _MONTH_SQL.format(
            where=f"WHERE year(tpep_pickup_datetime) * 100 + month(tpep_pickup_datetime) BETWEEN {_lo} AND {_hi}"
        )
    ),
)
def q_raw_pruned_month_counts(spark, sf_dir):
    """Raw-month pruning for a period (+-1 month) on the landed layout."""
    fx = _fx(spark, sf_dir)
    raw = P.prune_raw_months(RAW.read_raw_trips(spark, _land_fixture(fx)), NARROW_PERIOD)
    return raw.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "required_columns_missing",
    f"""SELECT c AS missing_column FROM (SELECT unnest([{", ".join(repr(c) for c in S.ZONE_COLUMNS)}]) AS c)
WHERE lower(c) NOT IN (SELECT lower(column_name) FROM (DESCRIBE region))
  AND c NOT IN (SELECT DISTINCT 'Borough' FROM region WHERE r_name IS NOT NULL)""",
)
def q_required_columns_missing(spark, sf_dir):
    """Zone columns that a lookup made of ``region`` alone lacks (S3); its names become boroughs."""
    found = FX.table(spark, sf_dir, "region").withColumnRenamed("r_name", "Borough").columns
    missing = RAW.missing_columns(found, S.ZONE_COLUMNS)
    return spark.createDataFrame([(c,) for c in missing], "missing_column string")


@query("zone_lookup_csv", O.with_zones("SELECT * FROM zones"))
def q_zone_lookup_csv(spark, sf_dir):
    """The zone lookup written as CSV with a header and read back."""
    fx = _fx(spark, sf_dir)
    return RAW.read_zones(spark, _zones_csv(fx))


@query(
    "period_coverage",
    O.with_raw(
        f"""SELECT m.year, m.month, CAST(coalesce(c.row_count, 0) AS BIGINT) AS row_count
FROM (SELECT CAST(year(ms) AS INTEGER) AS year, CAST(month(ms) AS INTEGER) AS month
      FROM (SELECT unnest(generate_series(DATE '{COVERAGE_PERIOD.start.replace(day=1)}',
                                          DATE '{COVERAGE_PERIOD.end.replace(day=1)}', INTERVAL 1 MONTH)) AS ms)) m
LEFT JOIN ({_MONTH_SQL.format(where="")}) c ON m.year = c.year AND m.month = c.month"""
    ),
)
def q_period_coverage(spark, sf_dir):
    return P.period_coverage(_fx(spark, sf_dir).raw, COVERAGE_PERIOD)


# ------------------------------------------------------------- profile (M*)

_P = "tpep_pickup_datetime"
_D = "tpep_dropoff_datetime"
_MIN = f"date_diff('second', {_P}, {_D}) / 60.0e0"


def _profile_sql(lo: int = 1, hi: int = 265) -> str:
    return f"""SELECT {EXPECTED_YEAR} AS expected_year, {EXPECTED_MONTH} AS expected_month,
  COUNT(*) AS row_count, CAST(20 AS BIGINT) AS column_count,
  count_if({_P} IS NULL) AS null_pickup_datetime,
  count_if({_D} IS NULL) AS null_dropoff_datetime,
  count_if({_MIN} < 0) AS dropoff_before_pickup,
  count_if({_MIN} = 0) AS zero_duration_trips,
  count_if({_MIN} > 1440) AS trips_longer_than_24_hours,
  count_if(NOT coalesce(year({_P}) = {EXPECTED_YEAR} AND month({_P}) = {EXPECTED_MONTH}, false)) AS rows_outside_expected_month,
  strftime(MIN({_P}), '%Y-%m-%dT%H:%M:%S') AS minimum_pickup_datetime,
  strftime(MAX({_P}), '%Y-%m-%dT%H:%M:%S') AS maximum_pickup_datetime,
  count_if(trip_distance < 0) AS negative_trip_distance,
  count_if(trip_distance = 0) AS zero_trip_distance,
  count_if(trip_distance > 100) AS trip_distance_over_100_miles,
  MAX(trip_distance) AS maximum_trip_distance,
  count_if(fare_amount < 0) AS negative_fare_amount,
  count_if(tip_amount < 0) AS negative_tip_amount,
  count_if(total_amount < 0) AS negative_total_amount,
  count_if(total_amount > 1000) AS total_amount_over_1000,
  MAX(total_amount) AS maximum_total_amount,
  count_if(PULocationID < {lo} OR PULocationID > {hi}) AS invalid_pickup_location_ids,
  count_if(DOLocationID < {lo} OR DOLocationID > {hi}) AS invalid_dropoff_location_ids
FROM raw_trips"""


@query("profile_metrics", O.with_raw(_profile_sql()))
def q_profile_metrics(spark, sf_dir):
    return PR.profile_metrics(_fx(spark, sf_dir).raw, EXPECTED_YEAR, EXPECTED_MONTH)


# Amounts and distances negated, and a location range that the fixture leaves.
_NEGATED = """, negated AS (SELECT * REPLACE (-trip_distance AS trip_distance, -tip_amount AS tip_amount) FROM raw_trips)
"""


@query("profile_metrics_negated", O.with_raw(_NEGATED + _profile_sql(2, 25).replace("FROM raw_trips", "FROM negated")))
def q_profile_metrics_negated(spark, sf_dir):
    """Limits that the fixture itself never crosses."""
    raw = _fx(spark, sf_dir).raw
    raw = raw.withColumns({c: -F.col(c) for c in ("trip_distance", "tip_amount")})
    return PR.profile_metrics(raw, EXPECTED_YEAR, EXPECTED_MONTH, (2, 25))


@query(
    "profile_null_values",
    O.with_raw(
        f"""SELECT column_name, null_count, ROUND(null_count / __rows * 100, 2) AS null_percentage
FROM (UNPIVOT (SELECT COUNT(*) AS __rows, {_cols(f'count_if({c} IS NULL) AS {c}' for c in S.RAW_COLUMNS)} FROM raw_trips)
      ON {_cols(S.RAW_COLUMNS)} INTO NAME column_name VALUE null_count)
WHERE null_count > 0"""
    ),
)
def q_profile_null_values(spark, sf_dir):
    """Null count and percentage per column, only where > 0 (M7; I4 is its descending listing)."""
    return I.null_counts_desc(_fx(spark, sf_dir).raw)


_DUP_SQL = "SELECT CAST(coalesce(SUM(c - 1), 0) AS BIGINT) AS duplicate_rows FROM (SELECT COUNT(*) AS c FROM {src} GROUP BY {cols})"


@query("profile_duplicate_rows", O.with_raw(_DUP_SQL.format(src="raw_trips", cols=_cols(S.RAW_COLUMNS))))
def q_profile_duplicate_rows(spark, sf_dir):
    return PR.duplicate_rows(_fx(spark, sf_dir).raw)


@query(
    "profile_duplicate_rows_double_landing",
    O.with_raw(
        _DUP_SQL.format(src="(SELECT * FROM raw_trips UNION ALL SELECT * FROM raw_trips)", cols=_cols(S.RAW_COLUMNS))
    ),
)
def q_profile_duplicate_rows_twice(spark, sf_dir):
    """Every month landed twice: each row is one duplicate."""
    raw = _fx(spark, sf_dir).raw
    return PR.duplicate_rows(raw.unionByName(raw))


_SECTIONS = ("expected_period", "dataset", "schema", "date_quality", "distance_quality", "amount_quality", "location_quality")


def _report(fx: Fixture) -> DataFrame:
    path = os.path.join(fx.sf_dir, "lineitem.parquet")
    return PR.profile_report(fx.raw, EXPECTED_YEAR, EXPECTED_MONTH, "lineitem trips", path)


def _flat(report: DataFrame) -> DataFrame:
    """The nested document flattened; maps and lists as text, the size as a flag."""
    nulls = F.array_join(
        F.transform(F.array_sort(F.map_entries("null_values")), lambda e: F.concat_ws(":", e["key"], e["value"]["count"].cast("string"))), ","
    )
    return report.select(
        "file", (F.col("file_size_mb") > 0).alias("has_size"), nulls.alias("null_counts"),
        *[f"{s}.*" for s in _SECTIONS],
    ).withColumns({c: F.array_join(c, ",") for c in ("columns", "missing_required_columns")})


_REPORT_SQL = O.with_raw(
    f""", m AS ({_profile_sql()}), d AS ({_DUP_SQL.format(src="raw_trips", cols=_cols(S.RAW_COLUMNS))}),
n AS (SELECT string_agg(column_name || ':' || null_count, ',' ORDER BY column_name) AS null_counts
  FROM (UNPIVOT (SELECT {_cols(f'count_if({c} IS NULL) AS {c}' for c in S.RAW_COLUMNS)} FROM raw_trips)
        ON {_cols(S.RAW_COLUMNS)} INTO NAME column_name VALUE null_count) WHERE null_count > 0)
SELECT 'lineitem trips' AS file, true AS has_size, null_counts, m.* RENAME (expected_year AS year, expected_month AS month),
  duplicate_rows, '{",".join(S.RAW_COLUMNS)}' AS columns, '' AS missing_required_columns FROM m, d, n"""
)


@query("profile_report", _REPORT_SQL)
def q_profile_report(spark, sf_dir):
    """The nested profile document (M25), flattened."""
    return _flat(_report(_fx(spark, sf_dir)))


@query("profile_report_written", _REPORT_SQL)
def q_profile_report_written(spark, sf_dir):
    """The document written as JSON and read back (K4)."""
    import uuid

    from cabflow.sinks.parquet import write_json_report

    fx = _fx(spark, sf_dir)
    path = fx.scratch(f"report_{uuid.uuid4().hex[:10]}")
    report = _report(fx)
    write_json_report(report, path)
    return _flat(spark.read.schema(report.schema).json(path))


@query("sample_written", O.with_raw("SELECT least(COUNT(*), 10000) AS row_count FROM raw_trips"))
def q_sample_written(spark, sf_dir):
    """The first rows written as a sample and read back (K3)."""
    import uuid

    from cabflow.sinks.parquet import write_sample

    fx = _fx(spark, sf_dir)
    path = fx.scratch(f"sample_{uuid.uuid4().hex[:10]}")
    write_sample(fx.raw, path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count"))


@query("input_file_size", None)
def q_input_file_size(spark, sf_dir):
    """Size of the files behind the scan, in MB (rows-only check)."""
    return PR.input_size_mb(spark, os.path.join(sf_dir, "lineitem.parquet"))


@query(
    "processing_timestamps",
    O.with_enriched(f"SELECT '{RUN_TS:%Y-%m-%d %H:%M:%S}' AS processed, COUNT(*) AS row_count FROM enriched"),
)
def q_processing_timestamps(spark, sf_dir):
    """The run's processing time on every row."""
    text = F.date_format("processing_timestamp", "yyyy-MM-dd HH:mm:ss").alias("processed")
    return _fx(spark, sf_dir).enriched.groupBy(text).agg(F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------ inspector (I*)

@query("inspect_shape", O.with_raw("SELECT COUNT(*) AS row_count, CAST(20 AS BIGINT) AS column_count FROM raw_trips"))
def q_inspect_shape(spark, sf_dir):
    return I.shape(_fx(spark, sf_dir).raw)


_DUCK_TYPES = {"BIGINT": "bigint", "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double", "VARCHAR": "string", "INTEGER": "int"}


@query(
    "inspect_dtypes",
    f"""SELECT column_name, CASE column_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _DUCK_TYPES.items())} END AS data_type
FROM (DESCRIBE ({O.with_raw("SELECT * FROM raw_trips")}))""",
)
def q_inspect_dtypes(spark, sf_dir):
    return I.dtypes_frame(spark, _fx(spark, sf_dir).raw).drop("position")


@query(
    "inspect_head",
    O.with_raw(
        "SELECT * FROM raw_trips ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in S.RAW_COLUMNS) + " LIMIT 5"
    ),
)
def q_inspect_head(spark, sf_dir):
    return I.head(_fx(spark, sf_dir).raw, 5)


_NUM = [c for c in S.RAW_COLUMNS if c not in ("tpep_pickup_datetime", "tpep_dropoff_datetime", "store_and_fwd_flag")]


@query(
    "inspect_numeric_stats",
    O.with_raw(
        f"""SELECT column_name, COUNT(*) AS count, ROUND(AVG(value), 6) AS mean,
       ROUND(STDDEV_SAMP(value), 6) AS std, MIN(value) AS min,
       ROUND(quantile_cont(value, 0.25), 6) AS p25, ROUND(quantile_cont(value, 0.5), 6) AS p50,
       ROUND(quantile_cont(value, 0.75), 6) AS p75, MAX(value) AS max
FROM (UNPIVOT (SELECT {_cols(f'CAST({c} AS DOUBLE) AS {c}' for c in _NUM)} FROM raw_trips)
      ON {_cols(_NUM)} INTO NAME column_name VALUE value)
GROUP BY column_name"""
    ),
)
def q_inspect_numeric_stats(spark, sf_dir):
    return I.numeric_summary(_fx(spark, sf_dir).raw)


# ------------------------------------------------------- expectations (E, D)


def _expectation_sql(lo: int = 1, hi: int = 265, mostly: str = "0.999", ordered: str = "true", distance: str = "trip_distance") -> str:
    rows = [
        (f"'{Q.ROW_COUNT}'", "NULL", "rows >= 1", "0"),
        (f"'{Q.COLUMNS_ORDERED}'", "NULL", ordered, "0"),
        (f"'{Q.NOT_NULL}'", "'tpep_pickup_datetime'", "null_pickup = 0", "null_pickup"),
        (f"'{Q.NOT_NULL}'", "'tpep_dropoff_datetime'", "null_dropoff = 0", "null_dropoff"),
        (f"'{Q.BETWEEN}'", "'PULocationID'", "bad_pu = 0", "bad_pu"),
        (f"'{Q.BETWEEN}'", "'DOLocationID'", "bad_do = 0", "bad_do"),
        (f"'{Q.BETWEEN}'", "'trip_distance'",
         f"CASE WHEN dist_non_null = 0 THEN true ELSE (dist_non_null - bad_dist) / dist_non_null >= {mostly} END", "bad_dist"),
    ]
    selects = " UNION ALL ".join(
        f"SELECT {e} AS expectation, CAST({c} AS VARCHAR) AS column_name, {s} AS success, "
        f"CAST({u} AS BIGINT) AS unexpected_count FROM a"
        for e, c, s, u in rows
    )
    return O.with_raw(
        f""", a AS (SELECT COUNT(*) AS rows, count_if({_P} IS NULL) AS null_pickup,
  count_if({_D} IS NULL) AS null_dropoff,
  count_if(PULocationID < {lo} OR PULocationID > {hi}) AS bad_pu,
  count_if(DOLocationID < {lo} OR DOLocationID > {hi}) AS bad_do,
  count_if({distance} < 0) AS bad_dist, COUNT(trip_distance) AS dist_non_null FROM raw_trips)
{selects}"""
    )


@query("raw_expectations", _expectation_sql())
def q_raw_expectations(spark, sf_dir):
    return Q.raw_expectations(_fx(spark, sf_dir).raw)


@query("raw_expectations_violated", _expectation_sql(2, 25, "0.5", "false", "trip_distance - 5"))
def q_raw_expectations_violated(spark, sf_dir):
    """Limits that the fixture crosses and columns in another order."""
    raw = _fx(spark, sf_dir).raw
    raw = raw.select(*reversed(raw.columns)).withColumn("trip_distance", F.col("trip_distance") - 5)
    return Q.raw_expectations(raw, location_range=(2, 25), mostly=0.5)


@query(
    "raw_expectations_gate",
    f"SELECT bool_and(success) AS success, COUNT(*) AS expectations FROM ({_expectation_sql()})",
)
def q_raw_expectations_gate(spark, sf_dir):
    return Q.suite_success(Q.raw_expectations(_fx(spark, sf_dir).raw))


def _model_tests_sql() -> str:
    return O.with_routed(
        FULL_PERIOD,
        """, tests AS (
  SELECT 'stg_trips' AS model, 'pickup_datetime' AS column_name, count_if(pickup_datetime IS NULL) AS failures FROM stg_trips
  UNION ALL SELECT 'stg_trips', 'dropoff_datetime', count_if(dropoff_datetime IS NULL) FROM stg_trips
  UNION ALL SELECT 'stg_trips', 'pickup_location_id', count_if(pickup_location_id IS NULL) FROM stg_trips
  UNION ALL SELECT 'stg_trips', 'dropoff_location_id', count_if(dropoff_location_id IS NULL) FROM stg_trips
  UNION ALL SELECT 'trips_by_borough', 'pickup_borough', count_if(pickup_borough IS NULL)
            FROM (SELECT pickup_borough FROM stg_trips GROUP BY pickup_borough)
  UNION ALL SELECT 'trips_by_hour', 'pickup_hour', count_if(pickup_hour IS NULL)
            FROM (SELECT pickup_hour FROM stg_trips GROUP BY pickup_hour))
SELECT model, column_name, 'not_null' AS test, CAST(failures AS BIGINT) AS failures,
       CASE WHEN failures = 0 THEN 'PASS' ELSE 'ERROR' END AS status FROM tests""",
    )


@query("model_tests", _model_tests_sql())
def q_model_tests(spark, sf_dir):
    return Q.model_tests(_fx(spark, sf_dir).stg)


@query(
    "model_test_summary",
    f"""SELECT count_if(status = 'PASS') AS pass_count, count_if(status = 'WARN') AS warn_count,
       count_if(status = 'ERROR') AS error_count, COUNT(*) AS total_count FROM ({_model_tests_sql()})""",
)
def q_model_test_summary(spark, sf_dir):
    return Q.test_summary(Q.model_tests(_fx(spark, sf_dir).stg))


# ----------------------------------------------------- sinks, catalog, job (K*)


def _run_pipeline(
    spark, sf_dir, period: P.Period = FULL_PERIOD, shift_days: int = 0, out: str | None = None, **more
) -> tuple[DataFrame, str]:
    """Land the fixture, write the zone CSV, run the job into a fresh folder.

    Files are labelled ``shift_days`` before the pickups that they hold.
    """
    import uuid

    from cabflow.plans.pipeline import PipelineConfig, run_pipeline

    fx = _fx(spark, sf_dir)
    token = uuid.uuid4().hex[:10] if out is None else os.path.basename(out)
    out = out or fx.scratch(f"run_{token}")
    cfg = PipelineConfig(
        raw_root=_land_fixture(fx, shift_days),
        zones_path=_zones_csv(fx),
        curated_path=os.path.join(out, "curated"),
        rejected_path=os.path.join(out, "rejected"),
        period=period,
        curated_table=f"curated_trips_{token}",
        rejected_table=f"rejected_trips_{token}",
        run_ts=RUN_TS,
        fail_on_test_error=False,  # some zones of the fixture have no borough
        **more,
    )
    return run_pipeline(spark, cfg), token


_TESTS_CTE = _model_tests_sql().split(", tests AS (", 1)[1].rsplit("SELECT model, column_name", 1)[0]


@query(
    "pipeline_run",
    O.with_routed(
        FULL_PERIOD,
        f""", tests AS ({_TESTS_CTE}
SELECT DATE '{FULL_PERIOD.start}' AS period_start, DATE '{FULL_PERIOD.end}' AS period_end,
  (SELECT COUNT(*) FROM curated) AS curated_rows, (SELECT COUNT(*) FROM rejected) AS rejected_rows,
  (SELECT COUNT(DISTINCT pickup_date) FROM curated) AS curated_days,
  (SELECT COUNT(DISTINCT pickup_date) FROM rejected) AS rejected_days,
  CAST(0 AS BIGINT) AS stale_days_cleared, (SELECT COUNT(*) FROM tests) AS model_tests,
  (SELECT count_if(failures > 0) FROM tests) AS model_test_errors""",
    ),
)
def q_pipeline_run(spark, sf_dir):
    """The whole job (K7): landed raw -> curated/rejected tables -> models -> tests."""
    return _run_pipeline(spark, sf_dir)[0]


def _by_month_sql(period: P.Period) -> str:
    return O.with_routed(
        period,
        """SELECT 'curated' AS route, pickup_year, pickup_month, COUNT(*) AS trip_count FROM curated GROUP BY ALL
UNION ALL
SELECT 'rejected', pickup_year, pickup_month, COUNT(*) FROM rejected GROUP BY ALL""",
    )


def _by_month(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.groupBy("pickup_year", "pickup_month")
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .select(F.lit(route).alias("route"), "pickup_year", "pickup_month", "trip_count")
        for route, df in frames.items()
    ]
    return parts[0].unionByName(parts[1])


def _tables(spark, token: str) -> dict[str, DataFrame]:
    return {route: spark.table(f"{route}_trips_{token}") for route in ("curated", "rejected")}


@query("pipeline_tables_by_month", _by_month_sql(FULL_PERIOD))
def q_pipeline_tables_by_month(spark, sf_dir):
    """Both catalog tables read back after the job (K1, K2, K5), counted per month."""
    return _by_month(_tables(spark, _run_pipeline(spark, sf_dir)[1]))


@query("pipeline_strays_by_month", _by_month_sql(NARROW_PERIOD))
def q_pipeline_strays_by_month(spark, sf_dir):
    """The job over files labelled 75 days before their pickups: no trip of the period is lost."""
    return _by_month(_tables(spark, _run_pipeline(spark, sf_dir, NARROW_PERIOD, 75)[1]))


# One quarter of the fixture, in the middle of its files.
QUARTER = P.Period.parse("01/01/1998", "31/03/1998", min_year=FIXTURE_MIN_YEAR)


@query("pipeline_versioned_by_month", _by_month_sql(NARROW_PERIOD))
def q_pipeline_versioned_by_month(spark, sf_dir):
    """Both tables published as versions, a quarter of them a second time, read through the catalog (K1, K2, K5)."""
    import uuid

    out = _fx(spark, sf_dir).scratch(f"versions_{uuid.uuid4().hex[:10]}")
    _run_pipeline(spark, sf_dir, NARROW_PERIOD, 0, out, versioned=True)
    return _by_month(_tables(spark, _run_pipeline(spark, sf_dir, QUARTER, 0, out, versioned=True)[1]))


_MARTS_SQL = O.with_routed(
    NARROW_PERIOD,
    """SELECT 'borough' AS mart, pickup_borough AS key, COUNT(*) AS trip_count,
       ROUND(AVG(total_amount), 2) AS avg_total_amount, ROUND(AVG(trip_distance), 2) AS avg_trip_distance
FROM stg_trips GROUP BY pickup_borough
UNION ALL
SELECT 'hour', CAST(pickup_hour AS VARCHAR), COUNT(*), ROUND(AVG(total_amount), 2), ROUND(AVG(trip_distance), 2)
FROM stg_trips GROUP BY pickup_hour
UNION ALL
SELECT 'zone', pickup_zone, COUNT(*), ROUND(AVG(total_amount), 2), NULL
FROM stg_trips GROUP BY pickup_zone, pickup_borough""",
)


@query("marts_from_day_sums", _MARTS_SQL)
def q_marts_from_day_sums(spark, sf_dir):
    """The three marts from per-day sums, after a quarter's days were rewritten (A1-A3, K6)."""
    import uuid

    from cabflow.plans import day_sums as D

    out = _fx(spark, sf_dir).scratch(f"sums_{uuid.uuid4().hex[:10]}")
    sums = os.path.join(out, "day_sums")
    for period in (NARROW_PERIOD, QUARTER):
        _run_pipeline(spark, sf_dir, period, 75, out, day_sums_path=sums)
    parts = []
    for mart, key in (("borough", "pickup_borough"), ("hour", "pickup_hour"), ("zone", "pickup_zone")):
        build = {"borough": D.trips_by_borough, "hour": D.trips_by_hour, "zone": D.top_pickup_zones}[mart]
        rows = build(D.read_day_sums(spark, sums))
        distance = F.col("avg_trip_distance") if "avg_trip_distance" in rows.columns else F.lit(None).cast("double")
        parts.append(
            rows.select(
                F.lit(mart).alias("mart"), F.col(key).cast("string").alias("key"), "trip_count", "avg_total_amount",
                distance.alias("avg_trip_distance"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ------------------------------------------------------------------ streaming


def _incremental(
    spark, sf_dir, land_again: bool, shift_days: int = 0, period: P.Period = FULL_PERIOD, out: str | None = None, **more
) -> DataFrame:
    """The streaming (availableNow) job over the landed fixture, read back per month.

    Files are labelled ``shift_days`` before the pickups that they hold.
    """
    import uuid

    from cabflow.sources.landing import land_labelled
    from cabflow.streaming.incremental import run_incremental_once

    fx = _fx(spark, sf_dir)
    out = out or fx.scratch(f"stream_{uuid.uuid4().hex[:10]}")
    paths = {r: os.path.join(out, r) for r in ("curated", "rejected")}
    raw_root = _land_fixture(fx, shift_days)
    if land_again:
        raw_root = os.path.join(out, "raw")
        land_labelled(fx.raw, raw_root, *_label(0))
    args = dict(
        raw_root=raw_root,
        zones_path=_zones_csv(fx),
        curated_path=paths["curated"],
        rejected_path=paths["rejected"],
        checkpoint_root=os.path.join(out, "checkpoints"),
        period=period,
        run_ts=RUN_TS,
        **more,
    )
    run_incremental_once(spark, **args)
    if land_again:  # 1997 arrives a second time, in new files
        land_labelled(fx.raw.filter(F.year("tpep_pickup_datetime") == 1997), raw_root, *_label(0))
        run_incremental_once(spark, **args)
    return _by_month({r: spark.read.parquet(p) for r, p in paths.items()})


@query("incremental_tables_by_month", _by_month_sql(FULL_PERIOD))
def q_incremental_tables_by_month(spark, sf_dir):
    return _incremental(spark, sf_dir, False)


@query("incremental_relanded_by_month", _by_month_sql(FULL_PERIOD))
def q_incremental_relanded_by_month(spark, sf_dir):
    """A year of months landed twice gives the same tables."""
    return _incremental(spark, sf_dir, True)


@query("incremental_strays_by_month", _by_month_sql(FULL_PERIOD))
def q_incremental_strays_by_month(spark, sf_dir):
    """Files labelled two to three months before their pickups give the same tables."""
    return _incremental(spark, sf_dir, False, 75)


@query("incremental_catalog_by_month", _by_month_sql(NARROW_PERIOD))
def q_incremental_catalog_by_month(spark, sf_dir):
    """The tables that follow the stream, read through the catalog (K5)."""
    import uuid

    token = uuid.uuid4().hex[:10]
    tables = {f"{r}_table": f"{r}_trips_{token}" for r in ("curated", "rejected")}
    _incremental(spark, sf_dir, False, 0, NARROW_PERIOD, **tables)
    return _by_month(_tables(spark, token))


@query("pipeline_after_stream_by_month", _by_month_sql(NARROW_PERIOD))
def q_pipeline_after_stream_by_month(spark, sf_dir):
    """A batch run over a quarter of what the stream wrote: both read strays by one index."""
    import uuid

    out = _fx(spark, sf_dir).scratch(f"both_{uuid.uuid4().hex[:10]}")
    _incremental(spark, sf_dir, False, 75, NARROW_PERIOD, out)
    return _by_month(_tables(spark, _run_pipeline(spark, sf_dir, QUARTER, 75, out)[1]))
