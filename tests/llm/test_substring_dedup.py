import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cabflow.llm import substring_dedup as m
from tests.llm.edge_tables import documents


def brute(rows, window=m.WINDOW):
    """(doc_id, n_words, n_removed, kept_sha256) by the definition."""
    texts = [(i, re.findall("[^\x20\x09-\x0d]+", t or "")) for i, t in rows]
    order = lambda i: 2**63 - 1 if i is None else i
    first = {}
    for i, words in texts:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, 2**63), order(i))
    out = []
    for i, words in texts:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < order(i):
                gone |= set(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def corpus(seed, n=60, vocabulary=400):
    """Texts with passages of 30 to 90 words that stand in many of them, whole, cut or altered."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.choice([30, 49, 50, 51, 70, 90]))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(5)):
            words += [word() for _ in range(rng.randrange(60))]
            passage = list(rng.choice(passages))
            if rng.random() < 0.3:
                passage[rng.randrange(len(passage))] = word()
            words += passage[rng.randrange(3) :]
        rows.append((i, rng.choice([" ", "\n", "\t  "]).join(words)))
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return documents(spark, [(i, t, "s") for i, t in rows])


@pytest.mark.parametrize("bounds", [{}, {"max_spans": 2, "limit": 1_000}])
def test_equals_brute_force(spark, bounds):
    rows = corpus(1)
    assert got(m.digests(table(spark, rows), **bounds)) == brute(rows)


def test_awkward_rows(spark):
    rows = corpus(2, 20)
    shared = " ".join(f"p{k}" for k in range(80))
    rows += [(None, shared), (None, shared), (3, shared), (3, shared), (3, shared + " tail"), (50, shared.replace(" ", "\x0b"))]
    rows += [(51, None), (52, ""), (53, " \n\t "), (54, "one"), (55, "a b " * 40), (56, "a b " * 60), (57, "a b " * 60)]
    rows += [(58, " ".join(f"p{k}" for k in range(80))), (59, "é" * 20 + " " + shared)]
    assert got(m.digests(table(spark, rows))) == brute(rows)


def test_hot_passage_in_every_text(spark, monkeypatch):
    """A passage of 40 words in all texts, amid their own words: its anchors are passed over."""
    monkeypatch.setattr(m, "SPANS_PER_SHARD", 5)
    rng = random.Random(4)
    hot = " ".join(f"h{k}" for k in range(40))
    rows = [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(40)) + f" {hot} " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(40))) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    assert got(m.digests(table(spark, rows), max_spans=10)) == brute(rows)


def test_long_texts_and_words(spark, monkeypatch):
    monkeypatch.setattr(m, "BYTES_AT_ONCE", 1 << 10)
    monkeypatch.setattr(m, "WORDS_AT_ONCE", 1 << 7)
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(300)}" for _ in range(3000))
    huge = "x" * 5000
    rows = [(1, long), (2, "start " + long + " end"), (3, long[5000:9000]), (4, f"{huge} {long[:800]} {huge}"), (5, f"a {huge} {long[:800]}")]
    assert got(m.digests(table(spark, rows))) == brute(rows)


def test_a_megabyte_of_text(spark):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(200_000))
    rows = [(1, long[200_000:600_000]), (2, long), (3, "y" * 2_000_000 + " " + long[:2000])]
    out = {r["doc_id"]: r for r in m.digests(table(spark, rows)).collect()}
    inner = len(long[200_000:600_000].split()) - 2  # the cut words at both ends may differ
    assert inner <= out[2]["n_removed"] <= inner + 2
    assert out[3]["n_words"] == 1 + len(long[:2000].split()) and out[3]["n_removed"] >= len(long[:2000].split()) - 1


def test_operator_gives_texts_and_spans(spark):
    shared = " ".join(f"p{k}" for k in range(60))
    out = {r["doc_id"]: r for r in m.without_repeats(table(spark, [(1, f"a {shared}"), (2, f"b  c {shared} d")])).collect()}
    assert out[1]["kept"] == f"a {shared}" and out[1]["removed"] == []
    assert out[2]["kept"] == "b c d" and [tuple(s) for s in out[2]["removed"]] == [(2, 62)]


def test_empty_table(spark):
    assert m.digests(documents(spark, [])).count() == 0
    assert m.without_repeats(documents(spark, [(1, None, "a")])).first()["kept"] == ""


def test_automaton_against_all_windows():
    rng = random.Random(7)
    draw = lambda n: [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
    for _ in range(30):
        texts = sorted((rng.randrange(6), draw(rng.randrange(4, 40))) for _ in range(6))
        automaton = m.Automaton()
        for doc, words in texts:
            automaton.add(words, doc)
        reader = m.Reader(automaton.packed(4))
        for doc in range(7):
            text = draw(40)
            windows = {tuple(w[i : i + 4]) for d, w in texts if d < doc for i in range(len(w) - 3)}
            hits = {k for i in range(37) if tuple(text[i : i + 4]) in windows for k in range(i, i + 4)}
            assert {k for b, e in reader.spans(text, doc, 4) for k in range(b, e)} == hits


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(8)
    words = rng.integers(0, 2**63, 300, dtype=np.uint64)
    stops = np.full(300, 300)
    inner = words[100:190]

    def by_window(w, s):
        found = {}
        for gram, _, first, last in m.anchors(w, s, np.zeros(0, dtype=np.int64)):
            for g, a, b in zip(gram, first, last):
                for k in range(a, b + 1):
                    found[tuple(w[k : k + m.WINDOW])] = g
        return found

    whole, part = by_window(words, stops), by_window(inner, np.full(90, 90))
    assert len(whole) == 251 and len(part) == 41 and all(whole[k] == g for k, g in part.items())


def test_words_never_cross_texts():
    data = np.frombuffer(b"ab cdef  g", dtype=np.uint8)
    starts, ends = m.word_edges(data, np.array([0, 5, 5, 8, 10]))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == [b"ab", b"cd", b"ef", b"g"]
    column = pa.array([b"ab", b"", b"cd ef"], pa.binary()).slice(1)
    [(begin, raw, bounds)] = list(m.texts_at_once(column))
    assert begin == 0 and raw.tobytes() == b"cd ef" and bounds.tolist() == [0, 0, 5]
