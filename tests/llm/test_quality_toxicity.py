import numpy as np
from pyspark.sql import functions as F

from cabflow.llm import quality_rules as q
from cabflow.llm import toxicity as t
from cabflow.llm.common import load
from tests.llm.edge_tables import documents, prose, write

SF = "/root/testdata/sf0.01"


def brute_stats(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = (text or "").split("\n")
    real = [k for k, x in enumerate(lines) if x.strip(" \t\n\v\f\r")]
    dup = sum(lines[k] in lines[:k] for k in real)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= set(range(k, k + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


def test_stats_against_brute_force():
    texts = [None, "", " \n", "a b c", prose(60) + "\n" + prose(60), "x y z w " * 9, "é # ü |\n\n|\né # ü |\n", "a\x0bb\x0cc\x85d\xa0e"]
    for text in texts:
        assert q.text_stats(text)[:5] == brute_stats(text), text


def test_rules_cover_what_is_bad():
    rng = np.random.default_rng(1)
    stats = np.zeros((600, len(q.STATS)), dtype=np.int64)
    stats[:, 0] = rng.integers(50, 400, 600)
    stats[:, 2] = rng.integers(0, 5, 600)
    bad = np.arange(600) % 5 == 0
    stats[bad, 2] += stats[bad, 0]
    rules = q.learn_rules(stats, bad)
    x = q.features(stats)
    fired = np.zeros(600, dtype=bool)
    for rule in rules:
        fired |= q.covers(rule, x)
    assert (fired == bad).all()
    assert q.learn_rules(stats, np.zeros(600, dtype=bool)) == []


def test_verdicts_on_the_tables(spark):
    out = q.op4_quality_rules(spark, SF).alias("o").join(load(spark, SF, "labels"), "doc_id")
    c = out.groupBy("quality", "base_failed", "kept").count().collect()
    get = lambda **k: sum(r["count"] for r in c if all(r[n] == v for n, v in k.items()))
    assert get(quality=1, base_failed=False, kept=False) == 0
    assert get(quality=0, kept=False) >= 0.9 * get(quality=0)


def test_expression_matches_the_learned_list(spark):
    docs = load(spark, SF, "documents")
    rules = q.fit_rules(docs, load(spark, SF, "labels"))
    rows = q.with_verdict(docs, rules).select("quality_rule", "quality_stats.*").collect()
    stats = np.array([[r[s] for s in q.STATS] for r in rows])
    x = q.features(stats)
    for k, r in enumerate(rows):
        want = -1 if q.base_fails(r["n_words"], r["n_repeat_words"]) else next((i for i, rule in enumerate(rules, 1) if q.covers(rule, x[k : k + 1])[0]), 0)
        assert r["quality_rule"] == want


def test_quality_edges(spark, tmp_path):
    sf = write(spark, tmp_path, documents(spark), labels=[(1, 0, 1), (4, 1, 0), (None, None, None), (4, 1, 0), (5, None, 1)])
    out = q.op4_quality_rules(spark, sf)
    assert out.count() == 12
    assert not out.filter("doc_id = 1").first()["kept"]
    kept = q.kept_documents(load(spark, sf, "documents"), load(spark, sf, "labels"))
    assert kept.columns == load(spark, sf, "documents").columns
    assert q.kept_documents(documents(spark, []), load(spark, sf, "labels")).count() == 0


def test_fuzzy_trie_against_edit_distance():
    words = {"idiot": 5.0, "disgusting": 4.0, "scum": 3.0}
    trie = t.FuzzyTrie(words, {"achlich": 2.0})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        return row[-1]

    tokens = ["idiot", "idoit", "idit", "idiott", "idxot", "idixxt", "disgustin", "disgsutng", "disgsting", "scun", "scum", "dis", "", "diot", "idio", "zidiot", "disgustingly"]
    for token in tokens:
        want = 0.0
        for word, weight in words.items():
            allowed = 0 if len(word) < 5 else 1 if len(word) < 9 else 2
            d = distance(token, word)
            if d <= allowed:
                want = max(want, weight * (1.0, 0.6, 0.45)[d])
        assert trie.fuzzy(token) == want, token
    assert trie.match("achlichbe.") == 2.0 and trie.match("1d10t!") == 5.0 and trie.match("idiooooot") > 0


def test_quotation_is_told_from_abuse():
    memo = t.Memo(t.FuzzyTrie({"idiot": 5.0}, {}))
    direct, _, _, quoted = t.evidence("you are an idiot and that is all", memo)
    assert direct > 0 and quoted == 0
    for text in ('the report used "the word idiot here" only once', "he called someone idiot today", "“idiot” is a word"):
        direct, _, _, quoted = t.evidence(text, memo)
        assert direct == 0 and quoted > 0, text


def test_held_out_accuracy(spark):
    out = t.op3_toxicity(spark, "/root/testdata/sf0.1").join(load(spark, "/root/testdata/sf0.1", "labels"), "doc_id")
    c = {(r["toxic"], r["predicted"]): r["count"] for r in out.filter("held_out").groupBy("toxic", "predicted").count().collect()}
    assert c[1, 1] / (c[1, 1] + c.get((1, 0), 0)) > 0.85
    assert c[0, 0] / (c[0, 0] + c.get((0, 1), 0)) > 0.97


def test_toxicity_edges(spark, tmp_path):
    sf = write(spark, tmp_path, documents(spark), labels=[(4, 1, 1), (6, 1, 0), (None, None, None), (4, 0, 1), (7, 1, 0)])
    out = t.op3_toxicity(spark, sf).collect()
    assert len(out) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    bare = write(spark, tmp_path / "bare", documents(spark, []))
    assert t.op3_toxicity(spark, bare).count() == 0
    unlabelled = write(spark, tmp_path / "none", documents(spark))
    assert t.op3_toxicity(spark, unlabelled).agg(F.max("score")).first()[0] == 0.0
