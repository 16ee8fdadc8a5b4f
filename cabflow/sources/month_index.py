"""What each landed month holds: a written index that batch runs and the stream share.

One row a month folder: the fingerprint of its files, their merged schema, the pickup
days that they hold with row counts, and all days that they ever held. It answers two
questions without touching the rest of the history:

- *which folders hold a day?* A monthly file carries trips of any month (wrong clocks),
  so a period is read from every folder that holds one of its days, however far its
  label is, and from no other;
- *which columns are there?* The schema of the history is merged from the stored ones,
  so a run opens only the footers of months that changed since the last one.

The index lies in a hidden folder below the raw root, or where the caller says. Each use
lists the files first and reads only months whose files changed; what lands without this
library is therefore seen too. An entry is replaced as a whole, so a run that dies or runs
twice leaves a valid index. Its size is bounded by the calendar, not by the trips.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from cabflow.functions import trip_columns as C

PICKUP = "tpep_pickup_datetime"
FOLDER = "_month_index"
# Beyond this many separate runs of days a filter becomes a join.
MAX_RANGES = 100

_ENTRY = (
    "label int, folders array<string>, fingerprint bigint, files bigint, bytes bigint, row_count bigint, "
    "columns string, days array<struct<day: date, row_count: bigint>>, past array<date>"
)


@dataclass(frozen=True)
class Month:
    """One row of the index; ``label`` counts months (year * 12 + month - 1)."""

    label: int
    folders: tuple[str, ...]
    fingerprint: int
    bytes: int
    row_count: int
    columns: str
    days: dict[dt.date | None, int]
    past: frozenset[dt.date]

    @property
    def landed(self) -> bool:
        return bool(self.folders)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.columns))


def label_of(year, month):
    """Month count of a year and a month, numbers or columns."""
    return year * 12 + month - 1


def index_path(root: str, path: str | None = None) -> str:
    return path or f"{root.rstrip('/')}/{FOLDER}"


def listing(spark: SparkSession, root: str) -> DataFrame:
    """label, folders, fingerprint, files and bytes of each month folder: file metadata only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    folder = F.regexp_extract("path", r"/(year=\d+/month=\d+)/[^/]+$", 1)
    files = files.select(folder.alias("folder"), "path", "length", "modificationTime").filter(F.col("folder") != "")
    year, month = (F.regexp_extract("folder", rf"{n}=(\d+)", 1).cast("int") for n in ("year", "month"))
    return files.groupBy(label_of(year, month).alias("label")).agg(
        F.sort_array(F.collect_set("folder")).alias("folders"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("fingerprint"),
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
    )


def stored(spark: SparkSession, path: str) -> dict[int, Month]:
    """The index as it was written last; a row a month."""
    try:
        rows = spark.read.schema(_ENTRY).parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return {r["label"]: _month(r) for r in rows}


def _month(r) -> Month:
    return Month(
        r["label"],
        tuple(r["folders"] or ()),
        r["fingerprint"] or 0,
        r["bytes"] or 0,
        r["row_count"] or 0,
        r["columns"],
        {d["day"]: d["row_count"] for d in r["days"] or []},
        frozenset(r["past"] or ()),
    )


def _columns_of(spark: SparkSession, root: str, folders: Iterable[str]) -> str:
    """The merged schema of a month's files as JSON: their footers are opened, no others."""
    paths = [f"{root.rstrip('/')}/{f}" for f in folders]
    return spark.read.option("mergeSchema", True).parquet(*paths).schema.json()


def refresh(
    spark: SparkSession, root: str, path: str | None = None, written: dict[int, str] | None = None
) -> dict[int, Month]:
    """The index, brought up to date: only months whose files changed are read.

    ``written`` has the schemas of months that the caller has just replaced, so that not
    even their footers are opened.
    """
    where = index_path(root, path)
    known = stored(spark, where)
    found = {r["label"]: r for r in listing(spark, root).collect()}  # a row a month
    changed = sorted(k for k, r in found.items() if k not in known or known[k].fingerprint != r["fingerprint"])
    gone = sorted(k for k, m in known.items() if k not in found and m.landed)
    if not changed and not gone:
        return known
    with ThreadPoolExecutor(8) as pool:
        of = lambda k: (written or {}).get(k) or _columns_of(spark, root, found[k]["folders"])
        columns = dict(zip(changed, pool.map(of, changed)))
    held: dict[int, dict] = {k: {} for k in changed}
    if changed:
        now = [Month(k, tuple(found[k]["folders"]), 0, 0, 0, columns[k], {}, frozenset()) for k in changed]
        for r in _held_days(read_months(spark, root, now)).collect():  # a row a month and day
            held[r["label"]][r["day"]] = r["row_count"]
    rows = []
    for k in changed:
        past = set(held[k]) - {None} | (known[k].past if k in known else set())
        r = found[k]
        counts = sorted(held[k].items(), key=lambda x: (x[0] is None, x[0] or dt.date.min))
        rows.append(
            (k, list(r["folders"]), r["fingerprint"], r["files"], r["bytes"], sum(held[k].values()), columns[k], counts, sorted(past))
        )
    rows += [(k, [], 0, 0, 0, 0, known[k].columns, [], sorted(known[k].past)) for k in gone]
    entries = spark.createDataFrame(rows, _ENTRY)
    whole = entries.withColumn("part", F.col("label")).repartition(max(1, min(16, len(rows))), "part")
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(where)
    return known | {r["label"]: _month(r) for r in entries.collect()}


def pickup_time(trips: DataFrame) -> Column:
    """The pickup time, whatever type the files give it."""
    kind = trips.schema[PICKUP].dataType
    return F.col(PICKUP) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else C.coerce_timestamp(PICKUP)


def _held_days(raw: DataFrame) -> DataFrame:
    day = F.to_date(pickup_time(raw)) if PICKUP in raw.columns else F.lit(None).cast("date")
    label = label_of(F.col("year").cast("int"), F.col("month").cast("int"))
    return raw.groupBy(label.alias("label"), day.alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


# --- schemas --------------------------------------------------------------------

_WIDER = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]


def common_type(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both; whole numbers with fractions become doubles."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _WIDER and b in _WIDER:
        wider = max(a, b, key=_WIDER.index)
        return T.DoubleType() if wider == T.FloatType() else wider
    times = (T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampNTZType()
    raise ValueError(f"column {name} is {a.simpleString()} in some months and {b.simpleString()} in others")


def merged_schema(months: Iterable[Month]) -> T.StructType:
    """The columns of all months in the order they came up; names differ beyond their case."""
    fields: dict[str, T.StructField] = {}
    for month in sorted(months, key=lambda m: m.label):
        for f in month.schema.fields:
            key = f.name.lower()
            if key in fields:
                kind = common_type(f.name, fields[key].dataType, f.dataType)
                fields[key] = T.StructField(fields[key].name, kind)
            else:
                fields[key] = T.StructField(f.name, f.dataType)
    return T.StructType(list(fields.values()))


def read_months(
    spark: SparkSession, root: str, months: Iterable[Month], schema: T.StructType | None = None
) -> DataFrame:
    """Trips of the given months with their ``year`` and ``month``; other folders are not even listed.

    The schema comes from the index, so no footer is opened to plan the scan. Months of
    one schema are one scan; their columns are cast to the common types and absent ones
    are NULL. ``schema`` defaults to that of the given months.
    """
    months = [m for m in months if m.landed]
    schema = schema or merged_schema(months)
    wanted = [*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
    groups: dict[str, list[str]] = {}
    for m in months:
        groups.setdefault(m.columns, []).extend(f"{root.rstrip('/')}/{f}" for f in m.folders)
    frames = []
    for columns, paths in groups.items():
        own = T.StructType.fromJson(json.loads(columns))
        rows = spark.read.schema(own).option("basePath", root).parquet(*paths)
        names = {c.lower(): c for c in rows.columns}
        frames.append(
            rows.select(
                *[
                    (F.col(f"`{names[f.name.lower()]}`") if f.name.lower() in names else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in wanted
                ]
            )
        )
    if not frames:
        return spark.createDataFrame([], T.StructType(wanted))
    return reduce(DataFrame.unionByName, frames)


# --- days -------------------------------------------------------------------------


def holding(index: dict[int, Month], days: set[dt.date] | None = None, start=None, end=None) -> list[Month]:
    """Months that hold one of ``days``, or a day from ``start`` to ``end``."""
    if days is not None:
        return [m for m in index.values() if not days.isdisjoint(m.days)]
    return [m for m in index.values() if any(d is not None and start <= d <= end for d in m.days)]


def day_ranges(days: Iterable[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Runs of consecutive days as (first, last)."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if out and (day - out[-1][1]).days == 1:
            out[-1] = (out[-1][0], day)
        else:
            out.append((day, day))
    return out


def on_days(trips: DataFrame, days: Iterable[dt.date]) -> DataFrame:
    """Trips picked up on one of ``days``.

    Few runs of days become ranges of the pickup time that reach the scan; many become a
    broadcast of the days, which the calendar bounds.
    """
    days = sorted(days)
    ranges = day_ranges(days)
    pickup = pickup_time(trips)
    if len(ranges) <= MAX_RANGES:
        kind = "timestamp_ntz" if not isinstance(trips.schema[PICKUP].dataType, T.TimestampType) else "timestamp"
        at = lambda d: F.lit(d).cast(kind)
        inside = [(pickup >= at(a)) & (pickup < at(b + dt.timedelta(days=1))) for a, b in ranges]
        return trips.filter(reduce(lambda x, y: x | y, inside, F.lit(False)))
    some = trips.sparkSession.createDataFrame([(d,) for d in days], "__wanted date")
    return trips.join(F.broadcast(some), F.to_date(pickup) == F.col("__wanted"), "left_semi")
