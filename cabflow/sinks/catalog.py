"""Catalog registration of the day-partitioned tables and partition upkeep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from cabflow import schema as S
from cabflow.sinks.parquet import clear_days


def path_has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a Parquet dataset; a missing or empty folder holds none."""
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def _ddl(df: DataFrame, partition_cols: list[str]) -> str:
    fields = [f for f in df.schema.fields if f.name not in partition_cols]
    fields += [df.schema[c] for c in partition_cols]
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    like: DataFrame,
    partition_cols: list[str] = S.DAY_PARTITION,
) -> None:
    """Create or widen the external Parquet table, then load all its partitions."""
    create_table(spark, name, path, like, partition_cols)
    refresh_partitions(spark, name)


def create_table(
    spark: SparkSession, name: str, path: str, like: DataFrame, partition_cols: list[str] = S.DAY_PARTITION
) -> None:
    """Create the external table if absent, without scanning its partitions.

    Columns that ``like`` has and an existing table lacks are added to it; older
    partitions read NULL there.
    """
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({_ddl(like, partition_cols)}) USING parquet "
            f"PARTITIONED BY ({', '.join(partition_cols)}) LOCATION '{path}'"
        )
        return
    known = {c.lower() for c in spark.table(name).columns}
    new = [f for f in like.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def _partition(spec: dict[str, int | None]) -> str:
    return "PARTITION (" + ", ".join(f"{k}={'null' if v is None else v}" for k, v in spec.items()) + ")"


def day_spec(day: dt.date | None) -> dict[str, int | None]:
    """The partition of a day; None is that of rows without one."""
    return dict(zip(S.DAY_PARTITION, (day.year, day.month, day.day) if day else (None, None, None)))


def add_partitions(spark: SparkSession, name: str, specs: list[dict[str, int | None]], batch: int = 500) -> None:
    """Register just the given partitions (bounded by the run's period).

    Unlike a full repair, the cost does not grow with the table's history.
    """
    for i in range(0, len(specs), batch):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(map(_partition, specs[i : i + batch]))}")
    spark.catalog.refreshTable(name)


def drop_partitions(spark: SparkSession, name: str, specs: list[dict[str, int | None]], batch: int = 500) -> None:
    """Take the given partitions out of the table, as far as it has them; no file is deleted."""
    for i in range(0, len(specs), batch):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_partition, specs[i : i + batch]))}")
    spark.catalog.refreshTable(name)


def follow_batch(
    spark: SparkSession, name: str, path: str, like: DataFrame, held: set[dt.date | None], gone: set[dt.date | None]
) -> None:
    """Bring the table up to date with one micro-batch: days that it wrote, days that it took away.

    A table that is new is created and repaired once, for what earlier batches left;
    after that the cost follows the batch, not the history.
    """
    if not spark.catalog.tableExists(name):
        register_table(spark, name, path, like)
        return
    create_table(spark, name, path, like)
    order = lambda d: (d is None, d or dt.date.min)
    add_partitions(spark, name, [day_spec(d) for d in sorted(held, key=order)])
    drop_partitions(spark, name, [day_spec(d) for d in sorted(gone - held, key=order)])


def refresh_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def existing_partitions(spark: SparkSession, name: str, years: tuple[int, int] | None = None) -> list[dict[str, int]]:
    """Partition specs of a table, of the given years only if set (metadata, no data read)."""
    if years is None:
        found = spark.sql(f"SHOW PARTITIONS {name}").collect()
    else:
        found = [
            r
            for year in range(years[0], years[1] + 1)
            for r in spark.sql(f"SHOW PARTITIONS {name} PARTITION (pickup_year={year})").collect()
        ]
    out = []
    for row in found:
        spec = dict(kv.split("=", 1) for kv in row[0].split("/"))
        out.append({k: None if v == "null" or v.startswith("__HIVE_DEFAULT") else int(v) for k, v in spec.items()})
    return out


def clear_partitions(spark: SparkSession, name: str, path: str, specs: list[dict[str, int]]) -> None:
    """Drop the given partitions of an external table and delete their folders, without a Spark job."""
    if not specs:
        return
    drop_partitions(spark, name, specs)
    days = {(s["pickup_year"], s["pickup_month"], s["pickup_day"]) for s in specs}
    clear_days(spark, path, sorted({d[:2] for d in days}), lambda y, m, d: (y, m, d) in days)
