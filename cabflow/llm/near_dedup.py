"""Near-duplicate documents by MinHash with tensored banding.

A document is the set of its distinct word shingles. Two collections of ``bands``
short MinHash bands are computed, and every pair of a band of the first with a band
of the second is the key of one table: bands x bands tables from 2 x bands bands,
so the hashing grows with the square root of the tables. Documents with equal sets
are one node first. In each bucket every node is compared with one, its centre:
pairs whose minhashes agree in under half of the places are passed over (a pair at
similarity 0.8 does so with probability 1e-9), the others are confirmed on the full
sets, and connected components are formed.

Buckets that still hold several components are compared across them without
listing all pairs of a bucket. Two nodes x, y near the centre c share at most
min(|x & c|, |y & c|) shingles inside c; what they need beyond that must be shared
outside c. So only pairs that share enough shingles outside c (an equi-join on
those few shingles), or whose sizes need none, can link, and those are confirmed.
Nodes far from the centre met it by chance; they are paired within their bucket
with each other and with what the triangle inequality leaves, and confirmed alike.

Equality of shingles is equality of 64-bit hashes. With 12 + 12 bands of 3 rows a
pair at similarity 0.80 shares no bucket with probability 0.0004, at 0.85 with
0.00002; no bucket has a cap.

Defined results: words are runs of characters other than ASCII white space, A-Z
lower-cased; a text with fewer words than a shingle is one shingle; null and empty
texts are linked with nothing; rows that share a doc_id are one document; rows
without a doc_id stand alone and are kept; an empty table gives an empty result.
Whole texts are read; other columns are ignored (``deduplicated`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, small_batches, written

BANDS = 12
ROWS = 3
# Ids are broadcast up to this counted number of rows (one long each), joined by shuffle beyond it.
BROADCAST_IDS = 1_000_000

_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POWER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of every word, in order."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    space = _SPACE[raw]
    inside = ~space
    first = inside.copy()
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    at = np.flatnonzero(inside)
    word = np.cumsum(first)[at] - 1
    offset = at - starts[word]
    powers = np.empty(int(offset.max()) + 1, dtype=np.uint64)
    powers[0] = 1
    powers[1:] = _POWER
    np.multiply.accumulate(powers, out=powers)
    values = _BYTE[raw[at]] * powers[offset]
    cut = np.flatnonzero(offset == 0)
    return mix(np.add.reduceat(values, cut) + np.diff(np.append(cut, len(at))).astype(np.uint64))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < size:
        size = len(words)
    acc = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(acc)])
    return np.unique(acc)


def minhashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """2 x ``bands`` x ``rows`` minima of the shingles under different hashes."""
    rng = np.random.default_rng(8)
    n = 2 * bands * rows
    xor, odd = rng.integers(0, 2**63, n, dtype=np.uint64), rng.integers(0, 2**63, n, dtype=np.uint64) | np.uint64(1)
    return np.array([((shingles ^ x) * m).min() for x, m in zip(xor, odd)], dtype=np.uint64).reshape(-1, rows)


def bands_of(minima: np.ndarray) -> np.ndarray:
    """One hash for each row of minima."""
    acc = np.arange(1, len(minima) + 1, dtype=np.uint64)
    for column in minima.T:
        acc = mix(acc * np.uint64(0xD6E8FEB86659FD93) + column)
    return acc


def fingerprints(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n (set size), h1, h2 (of the set), two collections of bands, 16 bits of each minhash."""

    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            out = []
            for text in batch:
                s = shingle_set(text, size)
                if not len(s):
                    out.append((0, 0, 0, None, None, None))
                    continue
                minima = minhashes(s, bands, rows)
                h = bands_of(minima).view(np.int64)
                h1 = np.add.reduce(mix(s)).astype(np.uint64).view(np.int64)
                h2 = np.bitwise_xor.reduce(mix(s * np.uint64(0xD6E8FEB86659FD93))).view(np.int64)
                short = mix(minima.ravel()).astype(np.uint16).view(np.int16)
                out.append((len(s), int(h1), int(h2), h[:bands], h[bands:], short))
            yield pd.DataFrame(out, columns=["n", "h1", "h2", "first", "second", "sig"])

    prints.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    schema = "n long, h1 long, h2 long, first array<long>, second array<long>, sig array<smallint>"
    return docs.select("doc_id", F.pandas_udf(prints, schema)(F.col("text")).alias("p")).select("doc_id", "p.*")


def shingle_sets(docs: DataFrame, size: int):
    def sets(texts: pd.Series) -> pd.Series:
        return pd.Series([shingle_set(t, size).view(np.int64) for t in texts], dtype=object)

    sets.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return docs.select(F.col("doc_id").alias("id"), F.pandas_udf(sets, "array<long>")(F.col("text")).alias("shingles"))


def tensored_buckets(nodes: DataFrame) -> DataFrame:
    """key, id: a row per node and table."""
    tables = nodes.select("id", F.posexplode("first").alias("i", "a"), "second").select(
        "id", "i", "a", F.posexplode("second").alias("j", "b")
    )
    return tables.select(F.xxhash64("i", "a", "j", "b").alias("key"), "id")


def _enough(shared: Column, n: Column, m: Column) -> Column:
    """Whether so many shared shingles make sets of n and m similar by 0.8."""
    return 9 * shared >= 4 * (n + m)


def agreement(x: Column, y: Column) -> Column:
    """Share of equal minhashes: an estimate of the similarity."""
    same = F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda acc, p: acc + p)
    return same / F.size(x)


def estimated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) with their estimate."""
    left = nodes.select(F.col("id").alias("a"), F.col("sig").alias("asig"))
    right = nodes.select(F.col("id").alias("b"), F.col("sig").alias("bsig"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", agreement(F.col("asig"), F.col("bsig")).alias("estimate"))


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, an, bn (set sizes) and shared (shingles in both) of the pairs."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(right, "b").join(left, "a").select(
        "a", "b", F.size("sa").alias("an"), F.size("sb").alias("bn"), F.size(F.array_intersect("sa", "sb")).alias("shared")
    )


def linked(rows: DataFrame) -> DataFrame:
    return rows.filter(_enough(F.col("shared"), F.col("an"), F.col("bn"))).select("a", "b")


def near_centre(stars: DataFrame, found: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may link, both near one centre.

    ``stars`` are the compared pairs (centre a, node b).
    """
    label = found.select(F.col("id").alias("__id"), "component")
    of = lambda df, name, to: df.join(
        label.withColumnRenamed("component", to), F.col(name) == F.col("__id"), "left"
    ).withColumn(to, F.coalesce(to, name)).drop("__id")
    rows = of(of(stars, "b", "comp"), "a", "centre")
    open_centres = rows.filter("comp != centre").select("a").distinct()
    rows = rows.join(open_centres, "a", "left_semi")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    rows = rows.join(right, "b").join(left, "a").select(
        F.col("a").alias("c"), "b", "comp", (F.col("comp") == F.col("centre")).alias("central"),
        F.col("bn").alias("n"), "shared", F.array_except("sb", "sa").alias("outside"),
    )
    # Nodes of one large group meet under many centres: a pair is looked at under the first of those it shares.
    centres = rows.groupBy("b").agg(F.collect_set("c").alias("centres"))  # a node has one for each table at most
    rows = written(rows.join(centres, "b"))
    x = rows.filter("not central").select(
        "c", F.col("b").alias("x"), F.col("comp").alias("xc"), F.col("n").alias("xn"), F.col("shared").alias("xs"),
        "outside", F.col("centres").alias("xcs"),
    )
    y = rows.select(
        "c", F.col("b").alias("y"), F.col("comp").alias("yc"), "central", F.col("n").alias("yn"), F.col("shared").alias("ys"),
        "outside", F.col("centres").alias("ycs"),
    )
    first = F.col("c") == F.array_min(F.array_intersect("xcs", "ycs"))
    apart = (F.col("central") | (F.col("xc") < F.col("yc"))) & first
    inside, both = F.least("xs", "ys"), F.col("xn") + F.col("yn")
    most = inside + F.least(F.col("xn") - F.col("xs"), F.col("yn") - F.col("ys"))
    by_shingle = (
        x.withColumn("e", F.explode("outside")).drop("outside")
        .join(y.withColumn("e", F.explode("outside")).drop("outside"), ["c", "e"])
        .filter((9 * most >= 4 * both) & (9 * F.least("xn", "yn") >= 4 * both) & apart)
    )
    needed = by_shingle.groupBy("c", "x", "y").agg(
        F.count(F.lit(1)).alias("more"), F.first(inside).alias("inside"), F.first(both).alias("both")
    )
    needed = needed.filter(9 * (F.col("inside") + F.col("more")) >= 4 * F.col("both")).select("x", "y")
    # Pairs that need nothing outside the centre: y has at most 9/4 of x's share in it, less x.
    low = F.ceil(F.col("xn") * 4 / F.lit(5.0)).cast("int")
    high = F.floor(9 * F.col("xs") / F.lit(4.0) - F.col("xn")).cast("int")
    by_size = (
        x.drop("outside").filter(low <= high).withColumn("yn", F.explode(F.sequence(low, high)))
        .join(y.drop("outside"), ["c", "yn"])
        .filter((9 * F.least("xs", "ys") >= 4 * (F.col("xn") + F.col("yn"))) & apart)
        .select("x", "y")
    )
    return needed.union(by_size).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def far_from_centre(
    members: DataFrame, pairs: DataFrame, stars: DataFrame, found: DataFrame, nodes: DataFrame
) -> DataFrame:
    """Likely pairs (a, b) of different components in one bucket, one of them not near its centre.

    ``pairs`` has the estimates of all centres with their nodes. A node far from
    the centre can be linked with a near one only if that one's distance from the
    centre differs by at most 0.2; the estimate is given 0.2 (three and a half
    standard errors) on top.
    """
    rows = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = rows.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c")
    )
    rows = rows.join(mixed.filter("lo < hi and c > 2").select("key"), "key").filter("id != a")
    exact = stars.select(
        "a", F.col("b").alias("id"), (F.col("shared") / (F.col("an") + F.col("bn") - F.col("shared"))).alias("exact")
    )
    rows = rows.join(pairs.withColumnRenamed("b", "id"), ["a", "id"]).join(exact, ["a", "id"], "left")
    rows = written(rows.select("key", "id", "component", "estimate", "exact"))
    # Most buckets have no far node, and of the near ones only some are close enough to one.
    reach = rows.filter("exact is null").groupBy("key").agg(F.max("estimate").alias("reach"))
    rows = rows.join(reach, "key").filter("exact is null or exact <= reach + 0.4")
    rows = rows.join(nodes.select("id", "sig"), "id")
    rows = written(rows.select("key", "id", "component", "estimate", "exact", "sig"))
    x = rows.filter("exact is null").select(
        "key", F.col("id").alias("x"), F.col("component").alias("xc"), "estimate", F.col("sig").alias("xsig")
    )
    y = rows.select("key", F.col("id").alias("y"), F.col("component").alias("yc"), "exact", F.col("sig").alias("ysig"))
    close = F.when(F.col("exact").isNull(), F.col("x") < F.col("y")).otherwise(F.col("exact") <= F.col("estimate") + 0.4)
    likely = agreement(F.col("xsig"), F.col("ysig")) >= 0.5
    across = x.join(y, (x["key"] == y["key"]) & (F.col("xc") != F.col("yc")) & close & likely)
    return across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every node on a link."""
    edges = written(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component"))
    labels = written(labels)
    while True:
        near = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("component").alias("near")
        )
        lower = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("c"))
        jump = labels.select(F.col("id").alias("c"), F.col("component").alias("further"))
        moved = lower.join(jump, "c", "left").select("id", "was", F.least("c", F.coalesce("further", "c")).alias("component"))
        moved = written(moved)
        changed = moved.filter("component < was").limit(1).count()
        labels = moved.select("id", "component")
        if not changed:
            return labels


def _ids_side(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """Shingle sets of the documents whose id is in ``ids`` (column id)."""
    side = _ids_side(written(ids.distinct()).withColumnRenamed("id", "__id"))
    rows = docs.select("doc_id", "text").join(side, F.col("doc_id") == F.col("__id")).select("doc_id", "text")
    return written(shingle_sets(rows, size))


def near_components(docs: DataFrame, size: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    small_batches(docs.sparkSession)
    prints = written(fingerprints(docs, size, bands, rows))
    known = prints.filter("n > 0 and doc_id is not null")
    # Equal sets are one node, named by their smallest id.
    nodes = written(
        known.groupBy("h1", "h2", "n").agg(
            F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("first", "second", "sig")]
        )
    )
    # Every node makes bands x bands rows: enough tasks that none has to spill them.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = tensored_buckets(nodes.select("id", "first", "second").repartition(parts, "id"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    members = written(buckets.join(shared, "key"))
    # The centre of a bucket is its node with most neighbours: not one that met the others by chance.
    degree = members.groupBy("id").agg(F.sum("c").alias("degree"))
    centre = members.join(degree, "id").groupBy("key").agg(F.max(F.struct("degree", (-F.col("id")).alias("minus"))).alias("top"))
    members = members.select("key", "id").join(centre.select("key", (-F.col("top.minus")).alias("a")), "key")
    members = written(members)
    pairs = members.filter("id != a").select("a", F.col("id").alias("b")).distinct()
    pairs = written(estimated(pairs, nodes))
    near = pairs.filter("estimate >= 0.5").select("a", "b")
    sets = _sets_of(docs, near.select(F.col("a").alias("id")).union(near.select("b")), size)
    stars = written(compared(near, sets))
    links = linked(stars)
    found = components(links)

    more = linked(compared(near_centre(stars, found, sets), sets))
    far = written(far_from_centre(members, pairs, stars, found, nodes))
    others = _sets_of(docs, far.select(F.col("a").alias("id")).union(far.select("b")), size)
    more = written(more.union(linked(compared(far, others))))
    if more.limit(1).count():
        found = components(links.union(more))

    named = nodes.drop("first", "second", "sig").join(found, "id", "left").select(
        F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), F.col("n").alias("__n"),
        F.coalesce("component", "id").alias("component_id"),
    )
    same = (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")) & (F.col("n") == F.col("__n"))
    out = prints.drop("first", "second", "sig").join(named, same & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
    )


def deduplicated(docs: DataFrame, size: int = 5) -> DataFrame:
    """One document of each component, all columns."""
    gone = near_components(docs, size).filter(~F.col("kept")).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(_ids_side(written(gone)), F.col("doc_id") == F.col("__id"), "left_anti")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at similarity 0.8 of two-word shingles."""
    return near_components(load(spark, sf_dir, "documents"), size=2)


OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 1 THEN words
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS shingles
  FROM w
), n AS (SELECT doc_id, len(shingles) AS n, list_sort(shingles) AS shingles FROM s
), nodes AS (SELECT min(doc_id) AS id, n, shingles FROM n WHERE n > 0 GROUP BY n, shingles
), x AS (SELECT id, n, unnest(shingles) AS sh FROM nodes
), pairs AS (
  SELECT a.id AS a, b.id AS b, a.n AS an, b.n AS bn, count(*) AS hits
  FROM x a JOIN x b ON a.sh = b.sh AND a.id < b.id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs WHERE 100 * hits >= 80 * (an + bn - hits)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT id, id AS other FROM nodes
  UNION
  SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.other = e.a
), found AS (SELECT id, min(other) AS component FROM reach GROUP BY id
)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, coalesce(f.component, n.doc_id) AS component_id,
       n.doc_id = coalesce(f.component, n.doc_id) AS kept
FROM n LEFT JOIN nodes d ON n.n = d.n AND n.shingles = d.shingles AND n.n > 0
LEFT JOIN found f ON f.id = d.id
"""
