import hashlib

import numpy as np

from cabflow.llm import near_dedup as n
from cabflow.llm import suffix_dedup as s
from tests.llm.edge_tables import documents, prose


def brute_components(rows, size):
    sets = []
    for i, text, _ in rows:
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
        k = min(size, len(words))
        sets.append((i, {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set()))
    label = {i: i for i, _ in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                label[hi] = lo
    return {i: (len(x), find(i), find(i) == i) for i, x in sets}


def edited(text, at, word):
    words = text.split()
    for k in at:
        words[k % len(words)] = f"{word}{k}"
    return " ".join(words)


def near_rows():
    rows = [(i, prose(150, i), "a") for i in range(1, 25)]
    for i in range(25, 60):  # chains of edits: neighbours are similar, the ends are not
        rows.append((i, edited(rows[-1][1] if i % 6 else prose(150, i % 24 + 1), range(0, 10 + i % 5, 3), f"e{i}x"), "b"))
    rows += [(60, rows[3][1], "a"), (61, rows[3][1].upper(), "a"), (62, "one", "a"), (63, "ONE", "a"), (64, "one two", "a"), (65, None, "a"), (66, "", "a"), (67, " \t", "a")]
    rows += [(70 + i, edited(prose(100, 3), [i], "solo"), "c") for i in range(30)]  # a group of near copies
    return rows


def test_near_components_against_brute_force(spark):
    rows = near_rows()
    for size in (2, 5):
        out = {r["doc_id"]: tuple(r)[1:] for r in n.near_components(documents(spark, rows), size).collect()}
        assert out == brute_components(rows, size)


def pooled_edits(n, seed, words=120, pool=12, most=5):
    """Copies of one text, each with some edits out of a common pool: many centres, shared edits."""
    rng = np.random.default_rng(seed)
    base = prose(words, seed).split()
    edits = [(int(at), f"edit{k}") for k, at in enumerate(rng.choice(words, pool, replace=False))]
    rows = []
    for i in range(n):
        text = list(base)
        for k in rng.choice(pool, rng.integers(0, most + 1), replace=False):
            text[edits[k][0]] = edits[k][1]
        rows.append((1000 * seed + i, " ".join(text), "g"))
    return rows


def test_group_of_copies_with_shared_edits(spark):
    """Copies that are not near the group's centre hang on each other; every pair is looked at once."""
    rows = pooled_edits(150, 1) + pooled_edits(60, 2, words=60, pool=8, most=6)
    for size in (2, 5):
        out = {r["doc_id"]: tuple(r)[1:] for r in n.near_components(documents(spark, rows), size).collect()}
        assert out == brute_components(rows, size)


def test_pairs_of_a_group_are_listed_under_one_centre(spark, monkeypatch):
    """Four centres with the same nodes list the pairs of one centre."""
    far = 10**6
    ids = range(1, 61)
    shingles = {i: [*range(40), *(far + (i + k) % 20 for k in range(10))] for i in ids} | {c: [*range(50)] for c in range(101, 105)}
    sets = spark.createDataFrame(list(shingles.items()), "id long, shingles array<long>")
    pairs = [(c, i, 50, 50, 40) for c in range(101, 105) for i in ids]
    found = spark.createDataFrame([], "id long, component long")
    counts = []
    for centres in (1, 4):
        stars = spark.createDataFrame([p for p in pairs if p[0] <= 100 + centres], "a long, b long, an int, bn int, shared int")
        plan = n.near_centre(stars, found, sets)
        joined = plan._jdf.queryExecution().optimizedPlan().toString()
        assert "array_min(array_intersect(" in joined
        counts.append(sorted(map(tuple, plan.collect())))
    assert counts[0] == counts[1] and len(counts[0]) > 60


def test_near_dedup_keeps_one_of_each(spark):
    docs = documents(spark, near_rows())
    out = n.deduplicated(docs, 5)
    assert out.columns == docs.columns
    want = {i for i, (_, _, kept) in brute_components(near_rows(), 5).items() if kept}
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == want


def test_near_edges(spark):
    out = n.near_components(documents(spark), 2).collect()
    assert len(out) == 12
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(r["kept"] and r["component_id"] is None for r in by[None])
    assert {r["component_id"] for i in (4, 5, 9) for r in by[i]} == {4}
    assert [r["component_id"] for i in (1, 2, 3) for r in by[i]] == [1, 2, 3]
    assert n.near_components(documents(spark, []), 5).count() == 0


def test_word_hashes_follow_words():
    a = n.word_hashes("The  cat\tsat é\n")
    assert len(a) == 4 and (a == n.word_hashes("the CAT sat é")).all()
    assert len(set(n.word_hashes("a b ab ba aa é").tolist())) == 6
    assert len(n.word_hashes("a\x85b\xa0c")) == 1


def brute_suffix(rows, length=100):
    seen, out = set(), {}
    for i, text, _ in sorted(rows, key=lambda r: r[0]):
        raw = s.bytes_of(text)
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            window = raw[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\x01" * length
            seen.add(window)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def suffix_rows():
    rng = np.random.default_rng(3)
    passages = [prose(60, 50 + k) for k in range(4)]
    rows = []
    for i in range(40):
        parts = [prose(40, 100 + i)]
        for _ in range(rng.integers(0, 3)):
            p = passages[rng.integers(0, 4)]
            a = rng.integers(0, 100)
            parts.append(p[a : a + rng.integers(80, 300)])
            parts.append(prose(int(rng.integers(1, 30)), 200 + i))
        rows.append((i, "".join(parts), "a"))
    rows += [(50, rows[5][1], "a"), (51, "ab" * 300, "a"), (52, "b" + "ab" * 200, "a"), (53, "é" * 120, "a"), (54, "é" * 60, "b")]
    rows += [(55, None, "a"), (56, "", "a"), (57, "x" * 99, "a"), (58, "x" * 100, "a"), (59, "x" * 101, "a"), (60, "\x00" * 150 + "é", "a")]
    return rows


def test_suffix_dedup_against_brute_force(spark):
    rows = suffix_rows()
    want = brute_suffix(rows)
    for most in (s.MAX_GROUP, 2):  # merged in buckets, and spread by hash
        out = {r["doc_id"]: tuple(r)[1:] for r in s.deduplicate(documents(spark, rows), most).collect()}
        assert out == want


def test_pieces_of_long_texts_do_not_matter(spark, monkeypatch):
    raw = np.frombuffer((prose(400, 1) + prose(300, 2) + prose(400, 1)).encode(), dtype=np.uint8)
    whole = {(a, k) for at, f, z, _ in s.anchors(raw) for a, lo, hi in zip(at, f, z) for k in range(lo, hi + 1)}
    monkeypatch.setattr(s, "PIECE", 257)
    cut = {(a, k) for at, f, z, _ in s.anchors(raw) for a, lo, hi in zip(at, f, z) for k in range(lo, hi + 1)}
    assert whole == cut


def test_loser_tree_merges_runs():
    rng = np.random.default_rng(5)
    for n_runs in (1, 2, 3, 7, 8):
        runs, every = [], []
        for k in range(n_runs):
            entries = [(bytes(rng.integers(97, 99, rng.integers(0, 12)).tolist()), (k, j)) for j in range(rng.integers(0, 30))]
            every += [e for e, _ in entries]
            runs.append(s.front_coded(entries))
        out = list(s.merge_runs([s.Run(r) for r in runs]))
        assert [o[0] for o in out] == sorted(every)
        before = b""
        for suffix, shared, _ in out:
            assert shared == s.common_prefix(before, suffix, 0)
            before = suffix


def test_suffix_edges(spark):
    out = s.deduplicate(documents(spark)).collect()
    assert len(out) == 12
    fives = [tuple(r) for r in out if r["doc_id"] == 5]
    assert fives[0] == fives[1] and fives[0][2] == fives[0][1]
    assert s.deduplicate(documents(spark, [])).count() == 0
