"""Importance resampling towards a target corpus: array-scored weights, then a parallel
sort by regular sampling.

1. Hashed features (runs of consecutive words) of the corpus and of the target are
   counted into one array each; the log ratio of every bucket is a fixed-size array of
   gains, and a document's weight is the sum of its features' gains.
2. Weight plus Gumbel noise drawn from a hash of the id is the score; the documents with
   the highest scores are the draw.
3. Ranks come from a parallel sort by regular sampling: every task sorts its rows (a run)
   and gives every ``stride``-th as a sample; the sorted samples give regular splitters;
   runs are cut at the splitters into segments, each bucket's segments are merged in one
   task, and the counts of the buckets before it make its ranks exact. Buckets wholly
   beyond the draw are counted but not exchanged.

A bucket holds about twice its share at most (``SAMPLES_PER_BUCKET`` runs or fewer), and
rows that are equal in all sort keys are spread over all buckets that their key spans, so
neither ties nor repeated rows gather in one task.

Defined results: a null or wordless text has no features and weight 0; a document without
an id draws its noise from the empty id and stands after all ids in ties; rows that
share an id are documents of their own with the same noise, ties among them go to fewer
features; an empty corpus gives no rows, an empty target counts as zero everywhere.
Other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, written

BUCKETS = 10_000
NGRAMS = 1
SCALE = 1000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

# Rows that one task merges, and how many regular samples choose the splitters.
ROWS_PER_BUCKET = 1_000_000
LEAST_PER_BUCKET = 1_000
MAX_BUCKETS = 16_384
SAMPLES_PER_BUCKET = 64

# A-Z become lower case; letters, digits and all bytes of other characters stay; the rest separates.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))

SCORED = "doc_id long, n_features long, weight long"


def features(text: bytes | None, ngrams: int = NGRAMS) -> Counter:
    """Runs of 1 to ``ngrams`` words with their counts."""
    words = (text or b"").translate(_LOWER).split()
    found = Counter(words)
    for n in range(2, ngrams + 1):
        found.update(b" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
    return found


def bucket_counts(df: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket: one array a task, then one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                for feature, n in features(text.as_py(), ngrams).items():
                    total[zlib.crc32(feature) % buckets] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    rows = df.select(F.col("text").cast("binary")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of each bucket's smoothed share in the target and in the corpus."""
    every, wanted = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    ratio = [(float(t) + 1) * every / ((float(s) + 1) * wanted) for s, t in zip(corpus, target)]
    return np.array([math.floor(SCALE * math.log(x)) for x in ratio], dtype=np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, ngrams: int = NGRAMS) -> DataFrame:
    """doc_id, n_features and weight of every document."""
    buckets = len(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, weight = [], []
            for text in batch.column(1):
                found = features(text.as_py(), ngrams)
                n = np.fromiter(found.values(), np.int64, len(found))
                at = np.fromiter((zlib.crc32(x) % buckets for x in found), np.int64, len(found))
                size.append(int(n.sum()))
                weight.append(int(n @ gain[at]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(weight, pa.int64())],
                ["doc_id", "n_features", "weight"],
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, F.col("text").cast("binary")).mapInArrow(weigh, SCORED)


def with_noise(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``score``: the weight plus Gumbel noise from a hash of the id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return df.withColumn("score", F.col("weight") + F.floor(F.lit(-float(SCALE)) * F.log(-F.log(uniform))))


# --- sort by regular sampling -----------------------------------------------------

_COLUMNS = ["score", "doc_id", "n_features", "weight"]
_SEGMENT = "bucket int, run int, seq int, n long, " + ", ".join(f"{c} array<long>" for c in _COLUMNS)


def _keys(columns: list[list]) -> list[tuple]:
    """Sort keys: higher scores first, smaller ids, no id last, fewer features."""
    score, doc_id, size = columns[:3]
    return [(-s, d is None, d or 0, n) for s, d, n in zip(score, doc_id, size)]


def _runs(df: DataFrame) -> DataFrame:
    """Rows sorted in each partition, which is a run; Spark's sort spills."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    return df.select(*_COLUMNS, F.spark_partition_id().alias("run")).sortWithinPartitions(*order)


def regular_samples(df: DataFrame, stride: int) -> list[tuple]:
    """Keys of every ``stride``-th row of each run, sorted."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            picked = range((stride // 2 - at) % stride, batch.num_rows, stride)
            yield batch.select(_COLUMNS[:3]).take(pa.array(picked, pa.int64()))
            at += batch.num_rows

    rows = _runs(df).mapInArrow(sample, "score long, doc_id long, n_features long").toArrow()
    return sorted(_keys([rows.column(i).to_pylist() for i in range(3)]))


def cuts(keys: list[tuple], splitters: list[tuple]) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of sorted ``keys``: bucket b holds keys up to splitter b.

    Splitters that repeat a key share its rows evenly.
    """
    out, begin = [], 0
    b = bisect_left(splitters, keys[0])
    while begin < len(keys) and b < len(splitters):
        last = bisect_right(splitters, splitters[b]) - 1
        left, right = bisect_left(keys, splitters[b], begin), bisect_right(keys, splitters[b], begin)
        same = last - b + 1
        for t in range(same):
            end = left + (right - left) * (t + 1) // same
            if end > begin:
                out.append((b + t, begin, end))
                begin = end
        b = last + 1
    if begin < len(keys):
        out.append((len(splitters), begin, len(keys)))
    return out


def segments(df: DataFrame, splitters: list[tuple]) -> DataFrame:
    """The runs cut at the splitters: one row for each bucket and batch of a run."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for seq, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            columns = [batch.column(i) for i in range(len(_COLUMNS))]
            parts = cuts(_keys([c.to_pylist() for c in columns[:3]]), splitters)
            run = batch.column(len(_COLUMNS))[0].as_py()
            ends = pa.array([0] + [e for _, _, e in parts], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, c) for c in columns]
            heads = [[b for b, _, _ in parts], [run] * len(parts), [seq] * len(parts)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(h, pa.int32()) for h in heads], pa.array([e - b for _, b, e in parts], pa.int64()), *lists],
                ["bucket", "run", "seq", "n", *_COLUMNS],
            )

    return _runs(df).mapInArrow(cut, _SEGMENT)


def merged(parts: DataFrame, offsets: list[int], last: int, draw: int) -> DataFrame:
    """Rows of the buckets up to ``last`` with their rank, null beyond the draw.

    Each task receives the segments of one bucket, joins those of a run and merges the runs.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[int, list] = {}
        bucket = None
        for batch in batches:
            for r in batch.select(["bucket", "run", *_COLUMNS]).to_pylist():
                bucket = r["bucket"]
                runs.setdefault(r["run"], []).append([r[c] for c in _COLUMNS])
        if bucket is None:
            return

        def rows(run: list) -> Iterator[tuple]:
            for columns in run:
                yield from zip(_keys(columns), *columns)

        out, rank = [], offsets[bucket]
        for _, *row in heapq.merge(*map(rows, runs.values()), key=lambda x: x[0]):
            rank += 1
            out.append((*row, rank if rank <= draw else None))
            if len(out) == 20_000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [*_COLUMNS, "rank"])

    dealt = parts.filter(F.col("bucket") <= last).repartitionById(last + 1, F.col("bucket"))
    dealt = dealt.sortWithinPartitions("run", "seq").drop("seq", "n")
    return dealt.mapInArrow(merge, ", ".join(f"{c} long" for c in [*_COLUMNS, "rank"]))


def drawn(scored: DataFrame, rows: int, draw: int) -> DataFrame:
    """``scored`` with the rank of each of its ``rows`` rows, null beyond ``draw``."""
    spark = scored.sparkSession
    if not draw:
        return scored.select(*_COLUMNS, F.lit(None).cast("long").alias("rank"))
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // LEAST_PER_BUCKET))
    buckets = min(MAX_BUCKETS, max(tasks, -(-rows // ROWS_PER_BUCKET)))
    sample = regular_samples(scored, max(1, rows // (buckets * SAMPLES_PER_BUCKET)))
    splitters = [sample[i * len(sample) // buckets] for i in range(1, buckets)]
    parts = written(segments(scored, splitters))
    held = {r["bucket"]: r["n"] for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # a row a bucket
    offsets, at = [], 0
    for b in range(buckets):
        offsets.append(at)
        at += held.get(b, 0)
    last = max(b for b in range(buckets) if offsets[b] < draw)
    rest = parts.filter(F.col("bucket") > last).select(F.inline(F.arrays_zip(*_COLUMNS)))
    return merged(parts, offsets, last, draw).unionByName(rest, allowMissingColumns=True)


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document.

    ``percent`` of the documents with at least ``min_words`` features are drawn without
    replacement, in proportion to the exponential of their weight (Gumbel top-k).
    """
    gain = gains(bucket_counts(docs, ngrams, buckets), bucket_counts(target, ngrams, buckets))
    scored = written(with_noise(weighted(docs, gain, ngrams), seed))
    enough = F.col("n_features") >= min_words
    able = scored.filter(enough)
    rows = able.count()
    ranks = drawn(able, rows, percent * rows // 100)
    out = ranks.unionByName(scored.filter(~enough), allowMissingColumns=True)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored towards the benchmark; the best tenth ranked."""
    return resample(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


# The reflected CRC-32 polynomial is a fixed value; its table follows by eight shifts a byte.
OP11_SQL = r"""
WITH tab AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), doc_words AS (
  SELECT row_number() OVER () AS no, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), doc_terms AS (
  SELECT no, word, count(*) AS n FROM (SELECT no, unnest(words) AS word FROM doc_words) GROUP BY ALL
), bench_terms AS (
  SELECT word, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark) GROUP BY ALL
), vocabulary AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_terms UNION SELECT word FROM bench_terms)
), buckets AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(0, length(h), 2), lambda i: ('0x' || substr(h, i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM vocabulary, tab
), s AS (
  SELECT bucket, sum(n) AS s FROM doc_terms JOIN buckets USING (word) GROUP BY bucket
), t AS (
  SELECT bucket, sum(n) AS t FROM bench_terms JOIN buckets USING (word) GROUP BY bucket
), totals AS (
  SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE + 10000 AS every,
         coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000 AS wanted
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * every / ((coalesce(s, 0)::DOUBLE + 1) * wanted)))::BIGINT AS g
  FROM s FULL JOIN t USING (bucket), totals
), scored AS (
  SELECT d.doc_id, len(d.words)::BIGINT AS n_features, coalesce(w.weight, 0)::BIGINT AS weight,
    (coalesce(w.weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM doc_words d LEFT JOIN (
    SELECT no, sum(n * g) AS weight FROM doc_terms JOIN buckets USING (word) JOIN gain USING (bucket) GROUP BY no) w USING (no)
), ranked AS (
  SELECT *, CASE WHEN n_features >= 20
    THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS r,
    count(*) FILTER (WHERE n_features >= 20) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * able // 100 THEN r END AS rank FROM ranked
"""
