"""Incremental landing of whole monthly files into ``year=YYYY/month=MM``."""

from __future__ import annotations

import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cabflow.sources import month_index as MI


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder, on whichever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def month_path(root: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/year={year}/month={month:02d}"


def month_landed(spark: SparkSession, root: str, year: int, month: int) -> bool:
    """Whether the month's folder holds trips: an empty folder, or one whose files are
    not whole Parquet files, does not count. One month's footers are read, no trips."""
    path = month_path(root, year, month)
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return False
    try:
        return not spark.read.parquet(path).isEmpty()
    except (AnalysisException, PySparkException, Py4JJavaError):  # no file, or a file without a footer
        return False


def land_labelled(source: DataFrame, root: str, year: Column, month: Column, index_path: str | None = None) -> None:
    """Write every row of ``source`` below ``root`` by the label of its file.

    The label is the month of the file a row came in, whatever its pickup time
    says: rows without a pickup and rows of other months stay in their file. Only
    the labelled months are replaced; the write is rebalanced by month, so a heavy
    month is split across tasks. Their schemas and days go into the month index.
    """
    out = source.withColumns(
        {"year": year.cast("int"), "month": F.lpad(month.cast("int").cast("string"), 2, "0")}
    ).drop("__year", "__month")
    months = Observation(f"landed_{uuid.uuid4().hex}")
    label = MI.label_of(F.col("year"), F.col("month").cast("int"))
    (
        out.observe(months, F.collect_set(label).alias("labels"))
        .hint("rebalance", "year", "month")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(root)
    )
    try:
        labels = months.get["labels"]  # one a month
    except Py4JJavaError:  # no row: the plan, and with it the observation, is gone
        labels = []
    schema = out.drop("year", "month").schema.json()
    MI.refresh(source.sparkSession, root, index_path, dict.fromkeys(labels, schema))


def land_months(
    sources: dict[tuple[int, int], DataFrame | str], root: str, overwrite: bool = False, index_path: str | None = None
) -> list[tuple[int, int]]:
    """Land the file of each (year, month), a frame or a Parquet path; return the months written.

    Months that are landed are skipped unless ``overwrite``; a month whose source has no
    row is an error, and nothing is written then. All sources are counted in one job.
    """
    spark = SparkSession.getActiveSession()
    todo = sorted(k for k in sources if overwrite or not month_landed(spark, root, *k))
    frames = {k: spark.read.parquet(s) if isinstance(s, str) else s for k, s in sources.items() if k in todo}
    if todo:
        labelled = [
            frames[k].withColumns({"__year": F.lit(k[0]), "__month": F.lit(k[1])}) for k in todo
        ]
        keys = reduce(DataFrame.union, [f.select("__year", "__month") for f in labelled])
        some = {(r[0], r[1]) for r in keys.groupBy("__year", "__month").count().collect()}  # a row a month
        if empty := [k for k in todo if k not in some]:
            raise ValueError(f"no source rows for month(s) {empty}")
        every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
        land_labelled(every, root, F.col("__year"), F.col("__month"), index_path)
    return todo
