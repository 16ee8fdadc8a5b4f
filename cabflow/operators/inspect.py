"""Inspector: schema listing, head, null counts and numeric statistics.

Numeric statistics are exact. Moments come from one wide aggregation. Quartiles are
selected by refinement: mergeable quantile sketches, one a column, give a
narrow bracket around each target rank; one more pass a column counts what lies below the
brackets and keeps only the values inside. No other value is shuffled, and a value that
stands a billion times is one row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.profile import null_counts

QUARTILES = (0.25, 0.5, 0.75)
STAT_DIGITS = 6
# A sketch's rank error is one part in ACCURACY; a bracket reaches this many errors each way.
ACCURACY = 10_000
MARGIN = 2.0
# Brackets that hold more values than this are narrowed by a further sketch first.
KEPT = 200_000
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def dtypes_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, column, data_type) rows for the table's schema."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def shape(df: DataFrame) -> DataFrame:
    """One row: row_count and column_count (the size of the files is ``input_size_mb``)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order over all columns (top-k, no global sort)."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in df.columns]).limit(n)


def null_counts_desc(df: DataFrame) -> DataFrame:
    return null_counts(df).orderBy(F.desc("null_count"), F.asc("column_name"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


@dataclass
class Bracket:
    """Values of a column among which the ranks around ``prob`` are looked for.

    ``count`` is the column's number of values (NaN apart), ``below`` of those under
    ``low``, ``inside`` of those from ``low`` to ``high``.
    """

    column: str
    prob: float
    count: int
    nans: int
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0
    margin: float = MARGIN

    @property
    def place(self) -> float:
        return self.prob * (self.count + self.nans - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        """The ranks that are interpolated, those of NaN (the largest) left out."""
        last = max(self.count - 1, 0)
        return min(math.floor(self.place), last), min(math.ceil(self.place), last)

    @property
    def found(self) -> bool:
        first, last = self.ranks
        return self.below <= first and last < self.below + self.inside

    def whole(self) -> None:
        self.low, self.high, self.below, self.inside = -math.inf, math.inf, 0, self.count


def _number(name: str) -> Column:
    return F.col(f"`{name}`").cast("double")


def _real(name: str) -> Column:
    """The column as double; NULL for NaN."""
    return F.nanvl(_number(name), F.lit(None).cast("double"))


def _sketch(value: Column, low: float, high: float) -> Column:
    """Values near two relative ranks; a rank of 0 or 1 is the extreme itself."""
    return F.percentile_approx(value, [min(max(low, 0.0), 1.0), min(max(high, 0.0), 1.0)], ACCURACY)


def _within(b: Bracket) -> Column:
    return _real(b.column).between(b.low, b.high)


def _narrow(df: DataFrame, brackets: list[Bracket]) -> None:
    """One sketch of each bracket's values, and one count of what its new bounds hold."""
    aims = []
    for i, b in enumerate(brackets):
        first, last = ((r - b.below) / max(b.inside, 1) for r in b.ranks)
        error = b.margin / ACCURACY
        aims.append(_sketch(F.when(_within(b), _real(b.column)), first - error, last + error).alias(f"b{i}"))
    row = df.agg(*aims).first()
    before = [(b.below, b.inside) for b in brackets]
    for i, b in enumerate(brackets):
        b.low, b.high = row[f"b{i}"]
    row = df.agg(
        *[F.count_if(_real(b.column) < b.low).alias(f"l{i}") for i, b in enumerate(brackets)],
        *[F.count_if(_within(b)).alias(f"i{i}") for i, b in enumerate(brackets)],
    ).first()
    for i, (b, (_, inside)) in enumerate(zip(brackets, before)):
        b.below, b.inside = row[f"l{i}"], row[f"i{i}"]
        if not b.found or (b.inside == inside and b.low < b.high):
            b.margin = 8 * b.margin + 1
            b.whole()


def _intervals(brackets: list[Bracket]) -> list[tuple[float, float]]:
    """The brackets of one column, overlapping ones as one."""
    out: list[tuple[float, float]] = []
    for low, high in sorted((b.low, b.high) for b in brackets):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _kept_values(df: DataFrame, intervals: dict[str, list[tuple[float, float]]]) -> DataFrame:
    """column_name, part, value, n: values inside the intervals counted one by one, the others together.

    Odd parts are the intervals, even ones what lies before, between and after them. Each
    column is counted on its own, from a scan of what it needs: its few conditions are
    compiled, which those of all columns in one row are not, and no row is multiplied.
    """
    frames = []
    for name, spans in intervals.items():
        v = F.col("value")
        part = F.lit(2 * len(spans))
        for i, (low, high) in reversed(list(enumerate(spans))):
            part = F.when(v < low, 2 * i).when(v <= high, 2 * i + 1).otherwise(part)
        inside = reduce(lambda a, b: a | b, [v.between(low, high) for low, high in spans])
        rows = df.select(_real(name).alias("value")).filter("value is not null")
        counts = rows.groupBy(part.alias("part"), F.when(inside, v).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        frames.append(counts.select(F.lit(name).alias("column_name"), "part", "value", "n"))
    return reduce(DataFrame.unionAll, frames)


def _select(df: DataFrame, brackets: list[Bracket]) -> dict[tuple[str, float], tuple]:
    """(value at the first rank, at the last) of each bracket; None where a rank lies outside."""
    by_column: dict[str, list[Bracket]] = {}
    for b in brackets:
        by_column.setdefault(b.column, []).append(b)
    kept = _kept_values(df, {c: _intervals(bs) for c, bs in by_column.items()})
    order = Window.partitionBy("column_name").orderBy("part", "value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = kept.withColumn("upto", F.sum("n").over(order))  # few values a column, by KEPT
    wanted = df.sparkSession.createDataFrame(
        [(b.column, b.prob, r) for b in brackets for r in b.ranks], "column_name string, prob double, rank long"
    ).distinct()
    hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    found = ranked.join(F.broadcast(wanted), "column_name").filter(hit)
    at = {(r["column_name"], r["prob"], r["rank"]): r["value"] for r in found.collect()}  # two rows a bracket
    return {(b.column, b.prob): tuple(at.get((b.column, b.prob, r)) for r in b.ranks) for b in brackets}


def _refined(df: DataFrame, brackets: list[Bracket]) -> dict[tuple[str, float], float]:
    """The interpolated value of each bracket."""
    out: dict[tuple[str, float], float] = {}
    todo = [b for b in brackets if b.count]
    for b in brackets:
        if not b.count and b.nans:
            out[b.column, b.prob] = math.nan
    while todo:
        while wide := [b for b in todo if b.inside > KEPT and b.low < b.high and b.margin < ACCURACY]:
            _narrow(df, wide)
        values = _select(df, todo)
        again = []
        for b in todo:
            low, high = values[b.column, b.prob]
            if low is None or high is None:  # the sketch was further off than it says
                b.margin = 8 * b.margin + 1
                b.whole()
                again.append(b)
                continue
            part = b.place - math.floor(b.place)
            if math.floor(b.place) >= b.count or (part and math.ceil(b.place) >= b.count):
                out[b.column, b.prob] = math.nan
            else:
                out[b.column, b.prob] = low + part * (high - low)
        todo = again
    return out


def _first_sketches(columns: list[str], probs) -> list[Column]:
    """Sketches and counts of whole columns, to be taken with other aggregates in one pass."""
    out = []
    for i, c in enumerate(columns):
        out += [F.count(_real(c)).alias(f"real_{i}"), F.count(_number(c)).alias(f"all_{i}")]
        ends = [min(max(p + d * MARGIN / ACCURACY, 0.0), 1.0) for p in probs for d in (-1, 1)]
        out.append(F.percentile_approx(_real(c), ends, ACCURACY).alias(f"near_{i}"))  # one sketch a column
    return out


def _brackets(row, columns: list[str], probs) -> list[Bracket]:
    out = []
    for i, c in enumerate(columns):
        count, nans = row[f"real_{i}"], row[f"all_{i}"] - row[f"real_{i}"]
        for j, p in enumerate(probs):
            b = Bracket(c, p, count, nans)
            b.whole()
            if count and count * (4 * MARGIN + 1) <= KEPT * ACCURACY and not nans:
                b.low, b.high = row[f"near_{i}"][2 * j : 2 * j + 2]  # few enough values inside to keep them
                b.inside = min(count, KEPT)
            out.append(b)
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probs=QUARTILES) -> DataFrame:
    """(column, prob, value): linearly interpolated exact quantiles.

    For n non-null values and probability p the position is p*(n-1); the
    result interpolates the values at its floor and ceiling ranks.
    """
    row = df.agg(*_first_sketches(columns, probs)).first()
    found = _refined(df, _brackets(row, columns, probs))
    rows = [(c, float(p), v) for (c, p), v in found.items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, prob double, value double")


def numeric_summary(df: DataFrame, columns: list[str] | None = None, probs=QUARTILES) -> DataFrame:
    """Per numeric column: count, mean, std, min, 25/50/75 %, max (exact).

    Moments, sketches, then what the brackets hold: a pass each, the last one column by column.
    """
    columns = columns or numeric_columns(df)
    stats = ("count", "mean", "std", "min", "max")
    aggs = []
    for i, c in enumerate(columns):
        v = _number(c)
        aggs += [
            F.count(v).alias(f"count_{i}"),
            F.round(F.avg(v), STAT_DIGITS).alias(f"mean_{i}"),
            F.round(F.stddev_samp(v), STAT_DIGITS).alias(f"std_{i}"),
            F.min(v).alias(f"min_{i}"),
            F.max(v).alias(f"max_{i}"),
        ]
    row = df.agg(*aggs).first()  # apart from the sketches, moments stay in generated code
    found = _refined(df, _brackets(df.agg(*_first_sketches(columns, probs)).first(), columns, probs))
    names = [f"p{int(round(p * 100))}" for p in probs]
    rows = [
        (c, *[row[f"{s}_{i}"] for s in stats], *[found.get((c, p)) for p in probs]) for i, c in enumerate(columns)
    ]
    kinds = ", ".join(f"`{n}` double" for n in (*stats[1:], *names))
    out = df.sparkSession.createDataFrame(rows, f"column_name string, count long, {kinds}")
    return out.select(
        "column_name", "count", "mean", "std", "min", *[F.round(n, STAT_DIGITS).alias(n) for n in names], "max"
    )
