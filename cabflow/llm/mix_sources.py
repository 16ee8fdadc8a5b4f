"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, served again from the start
when it is empty, ``max_epochs`` times at most. A copy of a document gets the
virtual finish time (tokens its source has served by its end) / (weight of the
source). Sorting all copies by finish time interleaves the sources by weight;
the mix ends where the total budget is spent, and the copy that stands there is
cut: that order and that end alone decide what is taken. A source that runs out
leaves its share to the others in proportion to their weights.

Targets are the exact shares of the same queues served word by word: the virtual time
of the end solves sum(min(weight * time, max_epochs * size)) = budget. What is taken of
a source differs from its target by a document of each source at most.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; sources of size 0 have target 0; rows with one doc_id are shuffled
side by side and each keeps its own row; equal rows are interchangeable; rows
without a doc_id are shuffled by their place in the table. An empty table gives an
empty result. Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm.common import load, materialized, running_sum, small_side, word_count

ROWS_PER_BUCKET = 10_000
QUEUE_ORDER = ("shuffle", "doc_id", "size")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """One row per source: rank, source, source_size, n_docs, weight, target.

    ``sizes`` has source and size. Only the one-row-per-source summary is
    ordered in a single window.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"), F.max("size").alias("longest")
    )
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    per = per.withColumn("rank", F.row_number().over(by_name).cast("int")).withColumn(
        "weight", F.element_at(cycle, F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("long")
    )
    cap = F.col("source_size") * max_epochs
    # The virtual time at which a source runs out, as an integer.
    runs_out = cap * (F.lit(lcm(*weights)).cast("long") / F.col("weight")).cast("long")
    everything = Window.partitionBy(F.lit(0))
    first_out = everything.orderBy("runs_out", "rank").rowsBetween(Window.unboundedPreceding, 0)
    per = (
        per.withColumn("cap", cap)
        .withColumn("runs_out", runs_out)
        .withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("cum_cap", F.sum("cap").over(first_out))
        .withColumn("cum_weight", F.sum("weight").over(first_out))
    )
    # Served by the time this source runs out, times its weight, against the budget.
    served = F.col("cum_cap") * F.col("weight") + F.col("cap") * (F.col("all_weight") - F.col("cum_weight"))
    per = per.withColumn("capped", served <= F.col("budget") * F.col("weight"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * left).cast("double") / open_weight.cast("double")
    )
    return per.withColumn("target", target).select(
        "rank", "source", "source_size", "n_docs", "weight", "target", "budget", "longest"
    )


def queues(docs: DataFrame, weights: tuple[int, ...], max_epochs: int, seed: str) -> tuple[DataFrame, dict]:
    """Every document in the shuffled queue of its source, and a summary of all queues.

    ``row`` tells the rows of the table apart, ``before`` are the words of the queue
    before the document. The summary has the virtual time of the end of the budget and
    the sum of the sources' longest documents.
    """
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = materialized(sizes.withColumn("row", F.monotonically_increasing_id()))
    targets = materialized(source_targets(sizes, weights, max_epochs))
    summary = targets.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.max(F.col("target") / F.col("weight")), F.lit(0.0)).alias("end"),
        F.coalesce(F.sum("longest"), F.lit(0)).alias("slack"),
    ).first().asDict()
    side = targets.withColumnRenamed("source", "__source").drop("longest")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string")))
    rows = (
        sizes.join(small_side(side, summary["n"]), F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("shuffle", F.md5(F.concat(F.lit(seed), name)))
    )
    spread = F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    rows = rows.withColumn(
        "bucket", F.floor(spread * F.ceil(F.col("n_docs") / F.lit(float(ROWS_PER_BUCKET)))).cast("long")
    )
    return running_sum(rows, ["rank"], "bucket", [*map(F.col, QUEUE_ORDER)], "size", "before").drop("bucket"), summary


def served(rows: DataFrame, summary: dict, max_epochs: int) -> DataFrame:
    """The copies in order of their finish time: position and the words that the budget leaves them.

    Copies that start after every queue has served its share of the budget are not listed:
    a queue lags behind its share by one document at most.
    """
    weight = F.col("weight").cast("double")
    copies = rows.filter("size > 0").withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(max_epochs)])))
    copies = copies.withColumn("start", F.col("epoch") * F.col("source_size") + F.col("before"))
    copies = copies.filter(F.col("start").cast("double") / weight <= F.lit(float(summary["end"] + summary["slack"])))
    copies = copies.withColumn("finish", (F.col("start") + F.col("size")).cast("double") / weight)
    # Equal spans of virtual time serve about equal tokens: they are the ranges of the global sort.
    spans = max(1, -(-summary["docs"] // ROWS_PER_BUCKET))
    span = F.floor(F.col("finish") / F.lit(summary["end"] or 1.0) * F.lit(spans)).cast("long")
    order = [F.col(c) for c in ("finish", "rank", "epoch", *QUEUE_ORDER)]
    placed = running_sum(copies.withColumn("span", span), [], "span", order, "size", "position")
    taken = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("budget") - F.col("position")))
    return placed.withColumn("words", taken).select(
        "row", "doc_id", "source", "size", "source_size", "target", "epoch", "finish", "position", "words"
    )


def mix_plan(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix"
) -> DataFrame:
    """One row per copy of a document that the mix considers.

    row (of the table), doc_id, source, size, source_size, target, epoch, finish
    (virtual), position (words before it in the global order), words (taken of it).
    """
    return served(*queues(docs, weights, max_epochs, seed), max_epochs)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken words."""
    rows, summary = queues(docs, weights, max_epochs, seed)
    columns = ["row", "doc_id", "size", "source_size", "target"]
    every = rows.select(*columns, F.lit(0).cast("long").alias("words"))
    copies = served(rows, summary, max_epochs).select(*columns, "words")
    taken = every.unionByName(copies).groupBy(*columns).agg(F.sum("words").alias("taken"))
    return taken.drop("row")


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 1, 2, 3 repeating, three epochs at most."""
    return mix(load(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || doc_id::VARCHAR) AS shuffle
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source
), cum AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS budget, sum(weight) OVER () AS all_weight,
         sum(3 * source_size) OVER w AS cum_cap, sum(weight) OVER w AS cum_weight
  FROM per
  WINDOW w AS (ORDER BY 3 * source_size * (6 // weight), source NULLS LAST ROWS UNBOUNDED PRECEDING)
), capped AS (
  SELECT *, cum_cap * weight + cap * (all_weight - cum_weight) <= budget * weight AS is_capped FROM cum
), targets AS (
  SELECT source, source_size, weight, budget,
         CASE WHEN is_capped THEN cap::DOUBLE ELSE
           (weight * (budget - coalesce(sum(cap) FILTER (WHERE is_capped) OVER (), 0)))::DOUBLE
           / (sum(weight) FILTER (WHERE NOT is_capped) OVER ())::DOUBLE END AS target
  FROM capped
), queue AS (
  SELECT s.doc_id, s.source, s.size, s.shuffle, t.source_size, t.target, t.weight, t.budget,
         (sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id, s.size
                            ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS before
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, (epoch * source_size + before + size)::DOUBLE / weight::DOUBLE AS finish
  FROM queue, (SELECT unnest([0, 1, 2]) AS epoch)
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, encode(source) NULLS LAST, epoch, shuffle, doc_id, size
                            ROWS UNBOUNDED PRECEDING) - size AS position
  FROM copies
)
SELECT doc_id, size, source_size, target, sum(greatest(0, least(size, budget - position)))::BIGINT AS taken
FROM placed GROUP BY doc_id, size, source_size, target
"""
