"""Texts and pages that once crashed an operator or took the square of their length."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cabflow.llm import html_extract as h
from cabflow.llm import pii
from cabflow.llm import secret_scan as s


def within(seconds, run):
    start = time.perf_counter()
    out = run()
    assert time.perf_counter() - start < seconds
    return out


# The contract's patterns as they are written there.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_emails_and_addresses_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@_-%+ b2/") for _ in range(rng.randrange(1, 40)))
        assert pii.emails(text) == [m.span() for m in EMAIL.finditer(text)]
        assert [m.span() for m in pii.IP.finditer(text)] == [m.span() for m in IP.finditer(text)]


@pytest.mark.parametrize(
    "text, found",
    [
        ("1" * 1_000_000, 0),
        ("a" * 1_000_000 + " x@y", 0),
        ("a" * 1_000_000 + "@b.c", 1),
        ("1.1" * 300_000, 75_000),
        ("a@" * 300_000, 0),
        ("+1" * 300_000, 0),
        ("+1" + " " * 1_000_000, 0),
    ],
)
def test_long_runs_take_time_in_proportion(text, found):
    assert len(within(20, lambda: pii.base_spans(text))) == found
    within(20, lambda: pii.candidates(text[:200_000]))


def entropy(run, window=s.WINDOW):
    best = 0.0
    for i in range(len(run) - window + 1):
        counts = Counter(run[i : i + window]).values()
        best = max(best, -sum(c / window * math.log2(c / window) for c in counts))
    return best


def test_window_entropy_of_all_lengths(spark):
    rng = random.Random(5)
    runs = ["".join(rng.choice(a) for _ in range(n)) for n in (0, 1, 19, 20, 21, 40, 75) for a in ("ab", "abcdef0123456789", "aB3/+=-_")]
    rows = spark.createDataFrame([(r,) for r in runs], "run string")
    got = {r["run"]: r["e"] for r in rows.select("run", s.max_window_entropy(F.col("run")).alias("e")).collect()}
    assert all(abs(got[r] - entropy(r)) < 1e-9 for r in runs)


def test_allow_list_equals_its_patterns(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("aZ/_-9") for _ in range(rng.randrange(1, 12))) for _ in range(4000)]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    for got, pattern in ((s.is_path, r"/?([A-Za-z_-]+/)+[A-Za-z_-]*"), (s.is_joined, r"[A-Za-z]+([_-][A-Za-z]+)+")):
        out = {r["w"]: r["x"] for r in rows.select("w", got(F.col("w")).alias("x")).collect()}
        assert all(out[w] == bool(re.fullmatch(pattern, w)) for w in words)


def test_scan_of_long_runs(spark):
    """A path of 100,000 segments, a megabyte of base64 and one of a single letter."""
    rng = random.Random(7)
    base64 = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(1_000_000))
    texts = [(1, "a/" * 100_000), (2, base64), (3, "x" * 1_000_000), (4, "a_" * 50_000 + "a"), (5, "f" * 1_000_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    out = within(120, lambda: {r["doc_id"]: r for r in s.with_secrets(docs).collect()})
    assert [len(out[i]["secret_added"]) for i in (1, 3, 4)] == [0, 0, 0]
    assert [(x["start"], x["end"]) for x in out[2]["secret_added"]] == [(0, 1_000_000)]
    assert [(x["start"], x["end"]) for x in out[5]["secret_base"]] == [(0, 1_000_000)]


def test_deep_pages():
    assert within(30, lambda: h.main_text("<div>" * 100_000 + "x", None)) == "x"
    assert h.main_text("<div>" * 100_000 + "x" + "</div>" * 100_000 + "y", None) == "x\ny"
    numbered = "".join(f"<div>a{i}" for i in range(600)) + "".join(f"</div>b{i}" for i in range(600))
    want = [f"a{i}" for i in range(600)] + [f"b{i}" for i in range(600)]
    assert h.main_text(f"<article>{numbered}</article>", None).split("\n") == want  # order and blocks stay below the greatest depth


def test_deep_menus_stay_out():
    deep = "<body><article>" + "<div>" * 300 + "<nav>menu<div>inner</div></nav><p>text</p>" + "</div>" * 300 + "<p>end</p>"
    assert h.main_text(deep, None) == "text\nend"
    assert h.main_text("<body>" + "<nav>" * 300 + "menu" + "</nav>" * 300 + "<p>text here</p>", None) == "text here"


def wide(first, last):
    return "".join(f"<div class='{chr(97 + i % 26) * (1 + i // 26)}'>t{i}</div>" for i in range(first, last))


def test_wide_pages():
    a, b = (h.wrapper_of(h.page_tree(wide(*r))) for r in ((0, 900), (100, 1000)))
    within(20, lambda: h.merged(a, b))
    assert len(within(20, lambda: h.main_text(wide(0, 1500), None)).split("\n")) == 1500


def test_alignment_of_long_lists():
    rng = random.Random(8)
    a = [rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(1500)]
    b = [x for x in a if rng.random() < 0.9]
    for pairs in (h.turns_in_common(a, b), [(i, j) for i, j in h.steps_of(a, b) if i is not None and j is not None]):
        assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs) and len({j for _, j in pairs}) == len(pairs)
        assert len(pairs) > 0.5 * len(b)
    steps = list(h.steps_of(a, b))
    assert [i for i, _ in steps if i is not None] == list(range(len(a)))
    assert [j for _, j in steps if j is not None] == list(range(len(b)))
