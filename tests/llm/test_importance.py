import hashlib
import math
import re
import zlib

import pytest

from cabflow.llm import importance as m
from tests.llm.edge_tables import documents, prose


def brute(docs, target, min_words=m.MIN_WORDS, percent=m.PERCENT):
    """doc_id, n_features, weight, score, rank by the definition; rows in any order."""

    def words(text):
        lower = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)

    bucket = lambda w: zlib.crc32(w.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for texts, counts in ((docs, s), (target, t)):
        for _, text in texts:
            for w in words(text):
                counts[bucket(w)] += 1
    every, wanted = sum(s) + 10000, sum(t) + 10000
    gain = [math.floor(1000 * math.log((b + 1) * every / ((a + 1) * wanted))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        found = words(text)
        weight = sum(gain[bucket(w)] for w in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = i
    return sorted(map(tuple, rows), key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def test_equals_brute_force_with_awkward_rows(spark):
    rows = [(i, prose(5 + i % 60, i), "s") for i in range(150)]
    rows += [(None, None, "s"), (None, prose(30), "s"), (None, prose(30), None), (7, prose(25, 3), "s"), (900, "", "s")]
    rows += [(901, "ÀÉ Straße 東京 A-b_c" * 30, "s"), (902, "x" * 300_000, "s"), (903, "Word " * 30_000, "s")]
    bench = [prose(40, 3), None, "", "東京 STRASSE word"]
    out = m.resample(documents(spark, rows), target_of(spark, bench))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert got(out) == brute([r[:2] for r in rows], list(enumerate(bench)))


def test_ranks_are_exact_over_many_runs_and_ties(spark, monkeypatch):
    """A third of the rows is one repeated row; ids repeat; many buckets."""
    monkeypatch.setattr(m, "LEAST_PER_BUCKET", 20)
    monkeypatch.setattr(m, "ROWS_PER_BUCKET", 30)
    rows = [(i % 300, prose(20 + i % 7, i % 11), "s") for i in range(600)] + [(5, prose(22, 4), "s")] * 300
    docs = documents(spark, rows).repartition(9)
    out = m.resample(docs, target_of(spark, [prose(50)]), percent=70)
    assert got(out) == brute([r[:2] for r in rows], [(0, prose(50))], percent=70)


def test_buckets_stay_even_where_one_key_fills_most_rows(spark):
    scored = spark.range(0, 8000, 1, 8).selectExpr(
        "if(id % 4 = 0, id, 1) as score", "if(id % 4 = 0, id, 3) as doc_id", "20L as n_features", "0L as weight"
    )
    sample = m.regular_samples(scored, 8000 // (10 * m.SAMPLES_PER_BUCKET))
    splitters = [sample[i * len(sample) // 10] for i in range(1, 10)]
    parts = m.segments(scored, splitters).groupBy("bucket").sum("n").collect()
    assert sum(r[1] for r in parts) == 8000 and max(r[1] for r in parts) <= 2 * 800


@pytest.mark.parametrize("splitters", [[], [5], [5, 5, 5], [1, 5, 5, 9], [0, 0, 12, 12]])
def test_cuts_keep_the_order_and_lose_no_row(splitters):
    keys = [(k,) for k in [0, 1, 1, 5, 5, 5, 5, 5, 5, 7, 9, 12, 12, 13]]
    parts = m.cuts(keys, [(s,) for s in splitters])
    assert [x for b, i, j in parts for x in keys[i:j]] == keys
    assert [b for b, _, _ in parts] == sorted({b for b, _, _ in parts})
    for b, i, j in parts:
        assert all(b == len(splitters) or k[0] <= splitters[b] for k in keys[i:j])
        assert all(b == 0 or k[0] >= splitters[b - 1] for k in keys[i:j])


def test_runs_of_several_words(spark):
    assert m.features(b"A b, C", 2) == {b"a": 1, b"b": 1, b"c": 1, b"a b": 1, b"b c": 1}


def test_empty_tables(spark):
    none = documents(spark, [])
    assert m.resample(none, target_of(spark, [])).count() == 0
    few = m.resample(documents(spark, [(1, None, "a"), (2, "one", "b")]), target_of(spark, [])).collect()
    assert [(r["n_features"], r["rank"]) for r in sorted(few)] == [(0, None), (1, None)]
