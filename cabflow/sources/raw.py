"""Raw sources: monthly trip files, the zone lookup, catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow import schema as S
from cabflow.sources import month_index as MI

# A lookup side is broadcast only below both bounds; beyond them the join is
# left to the planner (sort-merge, or AQE's runtime broadcast when the
# shuffled side turns out small).
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def read_raw_trips(spark: SparkSession, root: str, index_path: str | None = None) -> DataFrame:
    """Scan all of ``root`` (``year=YYYY/month=MM``) with its ``year`` and ``month``.

    The schema is merged from those stored in the month index, so a column that only
    some months have is NULL in the others and only footers of new files are opened.
    """
    index = MI.refresh(spark, root, index_path)
    return MI.read_months(spark, root, index.values())


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV with a header: the four columns by name, in any order, others ignored."""
    header = spark.read.option("header", True).csv(path).columns
    require_columns(header, S.ZONE_COLUMNS, what="zone lookup")
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    rows = spark.read.schema(as_text).option("header", True).csv(path)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.ZONE_SCHEMA.fields])


def missing_columns(columns, required) -> list[str]:
    """The required columns that are absent, sorted."""
    return sorted(set(required) - set(columns))


def require_columns(columns, required, what: str = "input") -> None:
    """Raise with the sorted list of required columns that are absent."""
    if missing := missing_columns(columns, required):
        raise ValueError(f"missing columns in {what}: {missing}")


def approx_row_bytes(df: DataFrame):
    """Rough in-memory width of one row: string bytes plus 8 per other column."""
    sizes = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)))
        else:
            sizes.append(F.lit(8))
    total = sizes[0]
    for s in sizes[1:]:
        total = total + s
    return total


def lookup_side(df: DataFrame, small: bool) -> DataFrame:
    """``broadcast(df)`` when its checked size fits, else ``df`` itself."""
    return F.broadcast(df) if small else df
