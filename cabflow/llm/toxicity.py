"""Toxicity scores from a lexicon trie intersected with Levenshtein automata.

The lexicon is learned from labels: whole words and word beginnings that documents
marked toxic use far more often than the others. It is kept in a trie. A token is
run through the product of the trie and a Levenshtein automaton, determinised
lazily, so one walk over the token finds every term within the allowed edits and
stops at the first letter that no term can explain; misspelled, letter-swapped and
digit-for-letter forms are caught that way. A variant that clean documents use as
a word of their own is no evidence.

Each hit is scored in its window of neighbouring words: a hit inside quotation
marks or after a reporting word counts as quoted, the others as direct abuse. A
logistic model of the direct, quoted and densest-window evidence gives the score.

Defined results: labels of rows with crc32(doc_id) mod 5 = 0 are never read; a null
or empty text scores as one without evidence; without labels of both classes every
score is 0; rows without a doc_id are not held out; repeated rows score alike; an
empty table gives an empty result. Only the text enters a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, materialized

# Labelled rows that train the lexicon and the model: a fixed bound, taken in order of a hash.
MAX_LABELLED = 20_000
MAX_TERMS = 2_000
STEMS = range(3, 9)
REACH = 10  # words on each side of a hit
EDGES = "\"'`.,;:!?()[]{}<>|*_~#%&«»“”„‘’‚…-–—/\\+="
OPENING, CLOSING = "\"“„«‘‚", "\"”“»’"
# Words that report what somebody else said.
REPORTING = frozenset(
    "said says called calls quote quoted quotes wrote writes reported stated"
    " dit disait cite écrit appelé sagte sagt nannte schrieb zitiert dijo dice llamó escribió cita".split()
)
LEET = str.maketrans("013457@$!|", "oieastasil")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def plain(token: str) -> str:
    return token.strip(EDGES)


class FuzzyTrie:
    """Terms in a trie; ``match`` walks its product with a Levenshtein automaton.

    A state is a set of (node, edits so far), closed under skipped term letters;
    its transitions are computed when first needed. ``words`` match as a whole,
    within one edit from 5 letters and two from 9; ``stems`` match as beginnings.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], stop: frozenset[str] = frozenset()):
        self.words, self.stems, self.stop = words, stems, stop
        self.longest = max(map(len, stems), default=0)
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[float, int] | None] = [None]
        self.most = 0
        for word, weight in words.items():
            allowed = 0 if len(word) < 5 else 1 if len(word) < 9 else 2
            self.most = max(self.most, allowed)
            node = 0
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                node = self.children[node][letter]
            self.ends[node] = (weight, allowed)
        self.states: list[frozenset[tuple[int, int]]] = []
        self.moves: list[dict[str, int]] = []
        self.number: dict[frozenset[tuple[int, int]], int] = {}
        self.start = self._state({0: 0})

    def _state(self, least: dict[int, int]) -> int:
        todo = list(least)
        while todo:  # skip letters of the term
            node = todo.pop()
            edits = least[node] + 1
            if edits <= self.most:
                for child in self.children[node].values():
                    if least.get(child, self.most + 1) > edits:
                        least[child] = edits
                        todo.append(child)
        state = frozenset(least.items())
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return self.number[state]

    def _move(self, state: int, letter: str) -> int:
        least: dict[int, int] = {}
        for node, edits in self.states[state]:
            for step, child in self.children[node].items():
                cost = edits + (step != letter)
                if cost <= self.most and least.get(child, self.most + 1) > cost:
                    least[child] = cost
            if edits < self.most and least.get(node, self.most + 1) > edits + 1:
                least[node] = edits + 1  # an extra letter in the token
        self.moves[state][letter] = to = self._state(least) if least else -1
        return to

    def fuzzy(self, token: str) -> float:
        """Weight of the best whole term within its allowed edits, discounted by them."""
        state = self.start
        for letter in token:
            to = self.moves[state].get(letter)
            state = self._move(state, letter) if to is None else to
            if state < 0:
                return 0.0
        best = 0.0
        for node, edits in self.states[state]:
            end = self.ends[node]
            if end and edits <= end[1]:
                best = max(best, end[0] * (1.0, 0.6, 0.45)[edits])
        return best

    def match(self, raw: str) -> float:
        """Evidence of one token, 0 for none."""
        token = plain(raw)
        if token in self.words:
            return self.words[token]
        for size in range(min(self.longest, len(token)), 2, -1):
            if token[:size] in self.stems:
                return self.stems[token[:size]]
        if len(token) < 4 or len(token) > 40 or token in self.stop:
            return 0.0
        if not token.isalpha():
            token = re.sub(r"[\W_]", "", token.translate(LEET))
            if not token.isalpha() or token in self.stop:
                return 0.0
            if token in self.words:
                return self.words[token]
        squeezed = re.sub(r"(.)\1{2,}", r"\1", token)
        if squeezed != token and squeezed in self.words:
            return self.words[squeezed]
        return self.fuzzy(token)


class Memo(dict):
    """Token -> evidence, forgotten when it has grown large."""

    def __init__(self, trie: FuzzyTrie, most: int = 400_000):
        super().__init__()
        self.trie, self.most = trie, most

    def __missing__(self, token: str) -> float:
        if len(self) >= self.most:
            self.clear()
        self[token] = value = self.trie.match(token)
        return value


def is_quoted(words: list[str], at: int) -> bool:
    """Whether the word stands between quotation marks, or shortly after a reporting word."""
    if words[at][0] in OPENING and words[at].rstrip(".,;:!?")[-1:] in CLOSING and len(words[at]) > 1:
        return True
    before, after = words[max(0, at - REACH) : at + 1], words[at : at + REACH + 1]
    opened = 0
    for word in before:
        opened += word[0] in OPENING
        opened -= word is not words[at] and len(word) > 1 and word.rstrip(".,;:!?")[-1:] in CLOSING
    if opened > 0 and any(w.rstrip(".,;:!?")[-1:] in CLOSING for w in after):
        return True
    return any(plain(w) in REPORTING for w in before[-4:-1])


def evidence(text: str | None, memo: Memo) -> tuple[float, float, float, float]:
    """Direct evidence, its densest window, its rate per word, and quoted evidence."""
    words = text.lower().split() if text else []
    found = list(map(memo.__getitem__, words))
    hits = [i for i, weight in enumerate(found) if weight]
    if not hits:
        return (0.0, 0.0, 0.0, 0.0)
    direct, quoted = [], 0.0
    for i in hits:
        if is_quoted(words, i):
            quoted += found[i]
        else:
            direct.append(i)
    densest = total = running = 0.0
    left = 0
    for k, i in enumerate(direct):
        running += found[i]
        total += found[i]
        while i - direct[left] > 2 * REACH:
            running -= found[direct[left]]
            left += 1
        densest = max(densest, running)
    return (math.log1p(total), math.log1p(densest), math.log1p(1000.0 * total / len(words)), math.log1p(quoted))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Newton steps of a ridge-penalised logistic regression; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents with each term, toxic and all: words as they are, beginnings with a trailing star."""
    for batch in batches:
        toxic, every = Counter(), Counter()
        for text, label in zip(batch["text"], batch["toxic"]):
            words = {w for w in map(plain, text.lower().split()) if w.isalpha()} if text else set()
            terms = words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
            every.update(terms)
            if label:
                toxic.update(terms)
        if every:
            yield pd.DataFrame({"term": list(every), "toxic": [toxic[t] for t in every], "every": list(every.values())})


class Model:
    """What the scoring needs: the trie's terms and the logistic weights."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], stop: frozenset[str], weights: list[float]):
        self.words, self.stems, self.stop, self.weights = words, stems, stop, weights

    def memo(self) -> Memo:
        return Memo(FuzzyTrie(self.words, self.stems, self.stop))


def cautious_odds(t, n, toxic: int, clean: int):
    """Log-odds of a term with the lower end of its toxic count and the upper end of its clean one."""
    low, high = t - 0.8 * np.sqrt(t) + 0.1, n - t + 0.8 * np.sqrt(n - t) + 1.0
    return np.log((low / (toxic + 1)) / (high / (clean + 1)))


def choose_terms(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> tuple[dict, dict]:
    """Words and stems that stand for themselves.

    A stem that one longer term explains (at least 80 % of its toxic documents)
    gives way to that term; a term that a chosen stem covers as well is left out.
    """
    support = {term: t for term, t, _ in counts}
    weights = {term: float(cautious_odds(t, n, toxic, clean)) for term, t, n in counts}
    explained: dict[str, int] = {}
    for term, t in support.items():
        body = term.rstrip("*")
        for k in STEMS:
            if k < len(body) or (k == len(body) and body == term):
                explained[body[:k]] = max(explained.get(body[:k], 0), t)
    words: dict[str, float] = {}
    stems: dict[str, float] = {}
    for term in sorted(support, key=lambda s: (len(s.rstrip("*")), not s.endswith("*"), s)):
        body, weight = term.rstrip("*"), weights[term]
        if body != term and explained.get(body, 0) >= 0.8 * support[term]:
            continue
        longest = len(body) - (body != term)
        if max((stems.get(body[:k], 0.0) for k in range(STEMS[0], longest + 1)), default=0.0) >= 0.8 * weight:
            continue
        (stems if body != term else words)[body] = weight
    return words, stems


def fit_model(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn lexicon and weights from at most ``max_labelled`` labelled rows that are not held out."""
    marked = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic")).filter(
        F.col("__id").isNotNull() & F.col("__toxic").isin(0, 1) & ~held_out(F.col("__id"))
    )
    marked = marked.orderBy(F.xxhash64(F.lit("toxic"), "__id"), "__id", "__toxic").limit(max_labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("__id"))
    # Copies would count as independent evidence: each text trains once.
    rows = materialized(rows.groupBy("text").agg(F.max(F.col("__toxic").cast("int")).alias("toxic")))
    counted = rows.mapInPandas(_term_counts, "term string, toxic long, every long")
    sums = materialized(counted.groupBy("term").agg(F.sum("toxic").alias("t"), F.sum("every").alias("n")))
    size = rows.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = size["t"] or 0, size["n"] - (size["t"] or 0)
    if not toxic or not clean:
        return Model({}, {}, frozenset(), [0.0, 0.0, 0.0, 0.0, -math.inf])
    low = F.col("t") - 0.8 * F.sqrt("t") + 0.1
    high = F.col("n") - F.col("t") + 0.8 * F.sqrt(F.col("n") - F.col("t")) + 1.0
    odds = F.log((low / (toxic + 1)) / (high / (clean + 1)))
    # Enough evidence, then the strongest: a bounded table.
    best = sums.filter((F.col("t") >= 4) & (odds >= 2.0)).orderBy((odds * F.sqrt("t")).desc(), "term").limit(MAX_TERMS)
    words, stems = choose_terms([(r["term"], r["t"], r["n"]) for r in best.collect()], toxic, clean)
    # Words of clean documents that lie within the edits of a term: bounded by the sample.
    trie = FuzzyTrie(words, stems)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[[trie.fuzzy(w) > 0 for w in batch["term"]]]

    own = sums.filter((F.col("n") > F.col("t")) & ~F.col("term").endswith("*") & (F.length("term") >= 4))
    stop = frozenset(
        r["term"] for r in own.select("term").mapInPandas(near, "term string").collect() if r["term"] not in words
    )
    model = Model(words, stems, stop, [])
    table = rows.select(features_of(model)(F.col("text")).alias("f"), "toxic").collect()
    x = np.array([[r["f"]["total"], r["f"]["densest"], r["f"]["rate"], r["f"]["quoted"]] for r in table])
    model.weights = fit_logistic(x, np.array([r["toxic"] for r in table], dtype=float)).tolist()
    return model


def features_of(model: Model):
    """A Pandas UDF: text -> struct<total, densest, rate, quoted>."""
    schema = "total double, densest double, rate double, quoted double"

    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = model.memo()
        for texts in batches:
            yield pd.DataFrame([evidence(t, memo) for t in texts], columns=["total", "densest", "rate", "quoted"], dtype="float64")

    features.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(features, schema)


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``toxicity``: 0 to 1."""
    f = F.col("__features")
    *slopes, base = model.weights
    if math.isinf(base):
        return docs.withColumn("toxicity", F.lit(0.0))
    logit = F.lit(base)
    for name, slope in zip(("total", "densest", "rate", "quoted"), slopes):
        logit = logit + F.lit(slope) * f[name]
    scored = docs.withColumn("__features", features_of(model)(F.col("text")))
    return scored.withColumn("toxicity", F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))).drop("__features")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = with_score(docs, fit_model(docs, load(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )
