"""Benchmark decontamination by aligned windows, in DataFrame functions only.

A document is searched for windows as long as a benchmark item (in words). All
shingles of all documents are looked up in the shingles of the benchmark; each shared
one aligns a window with its item. A window that shares no shingle with an item has
similarity 0, so nothing that could pass is lost. Every aligned window is verified
exactly: the weight of the item's shingles found in the window over the weight of all
its shingles must reach ``threshold``. A shingle weighs ln(1 + N / (1 + df)), df being
the documents of the corpus that hold it.

The 64-bit SimHashes of a found window and its item are reported by their Hamming
distance and decide nothing: they count all words alike, so a copy of an item's rare
part among other boilerplate can be far away.

Defined results: words are runs of letters and digits, lower-cased; a null or
empty text has none and matches nothing; an item of fewer than ``shingle`` words
is one shingle; a document shorter than an item is one window; rows that share a
doc_id, repeated items and (in ``leaks``) rows without a doc_id count as one
document; ``decontaminated`` judges rows without a doc_id by their text; empty
tables give an empty result. Other columns are ignored or passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, materialized, small_side

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 20


def norm_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, in order; empty if there are fewer words."""
    return F.when(
        F.size(words) >= size,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - size),
            lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """64-bit SimHash: bit b is set when more than half of the hashes have it."""
    bit = lambda h, b: F.call_function("shiftright", h, b).bitwiseAND(F.lit(1).cast("long"))
    ones = lambda b: F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc + bit(h, b))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("long"),
        lambda acc, b: acc.bitwiseOR(
            F.when(ones(b) * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(
                F.lit(0).cast("long")
            )
        ),
    )


def blocks(fingerprint: Column, radius: int) -> Column:
    """array<struct<no, value>>: the fingerprint cut into radius + 1 runs of bits."""
    n = radius + 1
    cuts = [round(64 * k / n) for k in range(n + 1)]
    return F.array(
        *[
            F.struct(
                F.lit(k).alias("no"),
                F.shiftright(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value"),
            )
            for k, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    )


def _window_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def leaks(
    docs: DataFrame,
    bench: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, item_id, start (word), hamming, similarity: the best window per pair."""
    items = bench.select("item_id", norm_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("n", F.size("words")).withColumn("k", F.least(F.col("n"), F.lit(shingle)))
    of_item = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("words"), k)) for k in range(1, shingle + 1)])
    items = materialized(items.withColumn("hashes", of_item).withColumn("print", simhash(_window_hashes(F.col("words")))))
    where = items.select("item_id", "n", F.posexplode("hashes").alias("j", "h"))
    # The sizes of shingle that occur: 1 .. shingle at most.
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())

    texts = docs.select("doc_id", norm_words(F.col("text")).alias("words"))
    none = F.array().cast("array<bigint>")
    grams = F.concat(none, *[shingle_hashes(F.col("words"), k) for k in sizes])
    n_shingles = items.agg(F.sum(F.size("hashes"))).first()[0] or 0
    if sizes in ([], [shingle]):
        found = texts.select("doc_id", F.posexplode(grams).alias("i", "h"))
    else:
        found = texts.select(
            "doc_id",
            F.explode(F.array(*[shingle_hashes(F.col("words"), k) for k in sizes])).alias("grams"),
        ).select("doc_id", F.posexplode("grams").alias("i", "h"))
    hits = materialized(found.join(small_side(where, n_shingles), "h").select("doc_id", "i", "h", "item_id", "j", "n"))

    n_docs = docs.select("doc_id").count()
    df = hits.groupBy("h").agg(F.countDistinct("doc_id").alias("df"))
    weighted = (
        where.select("item_id", "h").distinct().join(df, "h", "left")
        .withColumn("w", F.log(F.lit(1.0) + F.lit(float(n_docs)) / (F.lit(1.0) + F.coalesce("df", F.lit(0)))))
        .groupBy("item_id").agg(F.collect_list(F.struct("h", "w")).alias("weights"), F.sum("w").alias("all_w"))
    )
    known = materialized(items.join(weighted, "item_id").select("item_id", "k", F.col("print").alias("b_print"), "weights", "all_w"))

    starts = hits.select("doc_id", "item_id", "n", F.greatest(F.col("i") - F.col("j"), F.lit(0)).alias("start")).distinct()
    ids = starts.select(F.col("doc_id").alias("__id")).distinct()
    held = texts_of(docs, ids)
    windows = (
        starts.join(held, F.col("doc_id").eqNullSafe(F.col("__id")), "inner")
        .select("doc_id", "item_id", "n", "start", F.slice("words", F.col("start") + 1, F.col("n")).alias("words"))
        .filter(F.size("words") > 0)
    )
    near = windows.join(small_side(known, n_shingles), "item_id")
    in_window = F.coalesce(*[F.when(F.col("k") == k, shingle_hashes(F.col("words"), k)) for k in range(1, shingle + 1)])
    common = F.aggregate(
        "weights", F.lit(0.0), lambda acc, s: acc + F.when(F.array_contains(F.col("seen"), s["h"]), s["w"]).otherwise(0.0)
    )
    scored = near.withColumn("seen", in_window).withColumn("similarity", common / F.col("all_w"))
    best = scored.filter(F.col("similarity") >= threshold - 1e-9).groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("start", "words", "b_print", "similarity"), F.struct("similarity", -F.col("start"))).alias("best")
    )
    hamming = F.bit_count(simhash(_window_hashes(F.col("best.words"))).bitwiseXOR(F.col("best.b_print")))
    return best.select("doc_id", "item_id", "best.start", hamming.alias("hamming"), "best.similarity")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """__id and words of the documents whose id is in ``ids`` (column __id)."""
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "inner")
    return rows.select("__id", norm_words(F.col("text")).alias("words"))


def decontaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all columns."""
    key = F.coalesce(docs["doc_id"].cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(docs["text"], F.lit("")))))
    named = docs.select(key.alias("doc_id"), "text")
    bad = materialized(leaks(named, bench).select(F.col("doc_id").alias("__id")).distinct())
    return docs.join(small_side(bad, bad.count()), key == F.col("__id"), "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in all documents."""
    found = leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", F.round("similarity", 4).alias("similarity"))


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words
  FROM documents
), b AS (
  SELECT item_id, words, len(words) AS n FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words
    FROM benchmark) WHERE len(words) >= 5
), bs AS (
  SELECT item_id, n, j, array_to_string(words[j + 1 : j + 5], ' ') AS h
  FROM (SELECT *, unnest(range(0, n - 4)) AS j FROM b)
), ds AS (
  SELECT doc_id, i, array_to_string(words[i + 1 : i + 5], ' ') AS h
  FROM (SELECT *, unnest(range(0, len(words) - 4)) AS i FROM w WHERE len(words) >= 5)
), hits AS (SELECT ds.doc_id, ds.i, bs.item_id, bs.j, bs.n, bs.h FROM ds JOIN bs USING (h)
), df AS (SELECT h, count(DISTINCT doc_id) AS df FROM hits GROUP BY h
), weights AS (
  SELECT item_id, h, ln(1.0 + (SELECT count(*) FROM documents) / (1.0 + coalesce(df, 0))) AS wt
  FROM (SELECT DISTINCT item_id, h FROM bs) LEFT JOIN df USING (h)
), alls AS (SELECT item_id, sum(wt) AS all_w FROM weights GROUP BY item_id
), starts AS (SELECT DISTINCT doc_id, item_id, n, greatest(i - j, 0) AS start FROM hits
), seen AS (
  SELECT DISTINCT s.doc_id, s.item_id, s.start, ds.h
  FROM starts s JOIN ds ON ds.doc_id = s.doc_id AND ds.i >= s.start AND ds.i <= s.start + s.n - 5
), scored AS (
  SELECT doc_id, item_id, start, sum(wt) / any_value(all_w) AS sim
  FROM seen JOIN weights USING (item_id, h) JOIN alls USING (item_id) GROUP BY doc_id, item_id, start
)
SELECT doc_id, item_id, arg_max(start, struct_pack(a := sim, b := -start))::INTEGER AS start, round(max(sim), 4) AS similarity
FROM scored WHERE sim >= 0.8 - 1e-9 GROUP BY doc_id, item_id
"""
