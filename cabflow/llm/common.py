"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.session import shared_dir, shared_path

# A word is a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

# Whole texts go to Python workers in batches of at most so many rows: a batch stands in memory
# as Arrow on both sides and as Python objects, for each core of an executor.
TEXT_ROWS = 1_000

# A side is broadcast by hint only when it was counted and is this small.
BROADCAST_ROWS = 50_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for functions on texts; a lower setting stays.

    The setting is the session's: plans that run later read it too.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, TEXT_ROWS)


def materialized(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that all executors share."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a compressed table in the shared folder: less room than a checkpoint."""
    path = shared_path(df.sparkSession, f"written-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast for a side whose counted rows are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def word_count(text: Column) -> Column:
    """Words of a text as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(
    df: DataFrame, keys: list[str], bucket: str, order: list[Column], values: dict[str, str]
) -> DataFrame:
    """Add, for each ``new: value``, the sum of value over the rows before this one in its key.

    ``bucket`` is a column that never decreases along ``order`` within a key, so
    a hot key is split: its buckets are summed first, their offsets are
    accumulated over one row per bucket, and only the rows of one (key, bucket)
    meet in a task. Rows that tie on ``order`` may swap places among themselves.
    """
    before = (Window.unboundedPreceding, 0)
    over = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(bucket).rowsBetween(*before)
    sums = df.groupBy(*keys, bucket).agg(*[F.sum(v).alias(f"__s_{n}") for n, v in values.items()])
    offsets = sums.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col(bucket).alias("__kb"),
        *[(F.sum(f"__s_{n}").over(over) - F.col(f"__s_{n}")).alias(f"__o_{n}") for n in values],
    )
    on = [F.col(bucket) == F.col("__kb")] + [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    inner = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(*before)
    local = df.withColumns({f"__l_{n}": F.sum(v).over(inner) - F.col(v) for n, v in values.items()})
    joined = local.join(offsets, on, "inner")
    joined = joined.withColumns({n: F.col(f"__o_{n}") + F.col(f"__l_{n}") for n in values})
    extra = [f"__{kind}_{n}" for kind in "ol" for n in values]
    return joined.drop("__kb", *extra, *[f"__k{i}" for i in range(len(keys))])


def running_sum(
    df: DataFrame, keys: list[str], bucket: str, order: list[Column], value: str, name: str
) -> DataFrame:
    """:func:`running_sums` of one column."""
    return running_sums(df, keys, bucket, order, {name: value})


def native_spans(text: Column, pattern: str, groups: tuple[int, ...] = ()) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, match, g1, ...>>.

    Built from the matches and the pieces between them: a match starts after all
    earlier pieces and matches. Offsets are code points, the end is exclusive.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    more = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in groups]
    zipped = F.arrays_zip(
        found.alias("match"),
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("piece"),
        *[m.alias(f"g{g}") for g, m in zip(groups, more)],
    )
    names = ["match", "piece", *[f"g{g}" for g in groups]]
    kind = "array<struct<start:int,end:int," + ",".join(f"{n}:string" for n in names if n != "piece") + ">>"
    zipped = zipped.cast("array<struct<" + ",".join(f"{n}:string" for n in names) + ">>")
    start = lambda acc, x: acc["at"] + F.length(x["piece"])
    step = lambda acc, x: F.struct(
        (start(acc, x) + F.length(x["match"])).alias("at"),
        F.concat(
            acc["spans"],
            F.array(
                F.struct(
                    start(acc, x).alias("start"),
                    (start(acc, x) + F.length(x["match"])).alias("end"),
                    *[x[n].alias(n) for n in names if n != "piece"],
                )
            ),
        ).cast(kind).alias("spans"),
    )
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
    return F.when(F.size(found) > 0, F.aggregate(zipped, zero, step, lambda acc: acc["spans"])).otherwise(
        F.array().cast(kind)
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of array<struct<start, no, end, kind>>, by start, then kind number."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
