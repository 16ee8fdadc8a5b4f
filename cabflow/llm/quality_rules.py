"""Quality rules: a learned decision list over text statistics.

The statistics of a bounded sample of labelled documents train an ordered list of
rules by sequential covering: a conjunction of thresholds is grown by information
gain on two thirds of the sample, pruned on the other third, kept if it stays
precise, and the rows it covers are removed before the next rule. The list is
emitted as one Spark conditional expression over the statistics columns.

Defined results: words are runs of characters other than ASCII white space; a
null text has no words; a text with fewer than 20 words, or with over 30 % of its
words in repeated 8-word windows, always fails; without labels of both classes
the list is empty and only that base test decides. Repeated rows and rows that
share an id are judged one by one. Whole texts are read. Other columns of
``documents`` pass through unchanged; only the two added names are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import load, small_batches

# Labelled rows that train the list: a fixed bound, taken in order of a hash.
MAX_LABELLED = 20_000
MIN_WORDS = 20
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

STATS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_caps", "n_marks", "n_stops", "n_distinct", "n_digits",
)


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first one included."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, dtype=np.int64)
    edge[:n] += twice
    edge[window : window + n] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of ``STATS`` for one text."""
    if not text:
        return (0,) * len(STATS)
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        dup,
        repeated_words(hashes),
        lines,
        sum(map(bytes.isupper, words)),
        text.count("!") + text.count("?"),
        text.count("."),
        len(set(words)),
        sum(map(text.count, "0123456789")),
    )


@F.pandas_udf(T.StructType([T.StructField(s, T.LongType()) for s in STATS]))
def stats_of(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_stats(t) for t in text], columns=list(STATS), dtype="int64")


# Features of the rules: numerator and denominator among the statistics.
FEATURES = {
    "words": ("n_words", None),
    "word_length": ("word_chars", "n_words"),
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "line_length": ("n_words", "n_lines"),
    "caps": ("n_caps", "n_words"),
    "marks": ("n_marks", "n_words"),
    "stops": ("n_stops", "n_words"),
    "distinct": ("n_distinct", "n_words"),
    "digits": ("n_digits", "word_chars"),
}


def feature(stats: Column, name: str) -> Column:
    """A feature as a Spark expression over the statistics struct."""
    top, below = FEATURES[name]
    value = stats[top].cast("double")
    return value if below is None else value / F.greatest(stats[below], F.lit(1)).cast("double")


def features(stats: np.ndarray) -> np.ndarray:
    """The same features of rows of statistics."""
    at = {s: stats[:, i].astype(float) for i, s in enumerate(STATS)}
    return np.column_stack([at[a] if b is None else at[a] / np.maximum(at[b], 1) for a, b in FEATURES.values()])


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, list(FEATURES).index(self.feature)]
        return column >= self.threshold if self.at_least else column < self.threshold

    def expression(self, stats: Column) -> Column:
        value = feature(stats, self.feature)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    mask = np.ones(len(x), dtype=bool)
    for condition in rule:
        mask &= condition.holds(x)
    return mask


def _grow(x: np.ndarray, bad: np.ndarray, max_conditions: int) -> Rule:
    """Add the condition with the best information gain until no good row is covered."""
    rule: Rule = ()
    mask = np.ones(len(x), dtype=bool)
    names = list(FEATURES)
    while len(rule) < max_conditions and bad[mask].any() and (~bad[mask]).any():
        p, n = bad[mask].sum(), (~bad[mask]).sum()
        best, gain = None, 1e-9
        for j, name in enumerate(names):
            column = x[mask, j]
            order = np.argsort(column, kind="stable")
            values, is_bad = column[order], bad[mask][order]
            cut = np.flatnonzero(values[1:] > values[:-1]) + 1
            if not len(cut):
                continue
            below_p = np.cumsum(is_bad)[cut - 1]
            below_n = cut - below_p
            for at_least, cp, cn in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(cp > 0, cp * (np.log2(cp / (cp + cn)) - np.log2(p / (p + n))), 0.0)
                k = int(np.argmax(g))
                if g[k] > gain:
                    gain = g[k]
                    best = Condition(name, at_least, float((values[cut[k] - 1] + values[cut[k]]) / 2))
        if best is None:
            break
        rule = (*rule, best)
        mask &= best.holds(x)
    return rule


def _worth(rule: Rule, x: np.ndarray, bad: np.ndarray) -> float:
    mask = covers(rule, x)
    p, n = bad[mask].sum(), (~bad[mask]).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn_rules(
    stats: np.ndarray,
    bad: np.ndarray,
    max_rules: int = 12,
    max_conditions: int = 4,
    precision: float = 0.97,
    support: int = 5,
) -> list[Rule]:
    """Sequential covering: rules that reject, in order.

    A rule must cover ``support`` rows of the sample with ``precision``; the
    list ends at the first rule that does not.
    """
    x, bad = features(stats), bad.astype(bool)
    rules: list[Rule] = []
    for _ in range(max_rules):
        prune = np.arange(len(x)) % 3 == 2
        rule = _grow(x[~prune], bad[~prune], max_conditions)
        while len(rule) > 1:
            shorter = max((rule[:-1], *(rule[:i] + rule[i + 1 :] for i in range(len(rule) - 1))), key=lambda r: _worth(r, x[prune], bad[prune]))
            if _worth(shorter, x[prune], bad[prune]) < _worth(rule, x[prune], bad[prune]):
                break
            rule = shorter
        mask = covers(rule, x) if rule else np.zeros(len(x), dtype=bool)
        hit, held = bad[mask].sum(), bad[mask & prune].sum()
        if hit < support or hit < precision * mask.sum() or held < precision * (mask & prune).sum():
            break
        rules.append(rule)
        x, bad = x[~mask], bad[~mask]
    return rules


def rejected_by(rules: list[Rule], stats: Column) -> Column:
    """The list as an ordered conditional: number (from 1) of the first rule that fires, else 0."""
    out = F.lit(0)
    for k, rule in reversed(list(enumerate(rules, 1))):
        test = F.lit(True)
        for condition in rule:
            test = test & condition.expression(stats)
        out = F.when(test, F.lit(k)).otherwise(out)
    return out


def fit_rules(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Learn the list from at most ``max_labelled`` labelled rows, the first by hash of their id."""
    marked = labels.select(F.col("doc_id").alias("__id"), F.col("quality").alias("__quality")).filter(
        F.col("__id").isNotNull() & F.col("__quality").isin(0, 1)
    )
    order = [F.xxhash64(F.lit("quality"), "__id"), F.col("__id"), F.col("__quality")]
    marked = marked.orderBy(*order).limit(max_labelled)
    rows = docs.select("doc_id", "text").join(F.broadcast(marked), F.col("doc_id") == F.col("__id"))
    got = rows.select("__id", "__quality", stats_of("text").alias("s")).select("__id", "__quality", "s.*")
    # One id may stand on several rows; the bound holds for what reaches the driver too.
    got = got.orderBy(F.xxhash64(F.lit("quality"), "__id"), "__id", *STATS).limit(max_labelled).collect()
    # The base test comes first: the list learns what that test leaves.
    got = [r for r in got if not base_fails(r["n_words"], r["n_repeat_words"])]
    if not got:
        return []
    return learn_rules(
        np.array([[r[s] for s in STATS] for r in got], dtype=np.int64), np.array([r["__quality"] == 0 for r in got])
    )


def base_fails(n_words, n_repeat_words):
    """The base test, on numbers or on columns."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 30 * n_words)


def with_verdict(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``quality_stats`` (struct) and ``quality_rule``: -1 base test, 0 kept, k the rule that rejects."""
    stats = F.col("quality_stats")
    base = base_fails(stats["n_words"], stats["n_repeat_words"])
    return docs.withColumn("quality_stats", stats_of("text")).withColumn(
        "quality_rule", F.when(base, F.lit(-1)).otherwise(rejected_by(rules, stats))
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    small_batches(docs.sparkSession)
    judged = with_verdict(docs, fit_rules(docs, labels))
    return judged.filter(F.col("quality_rule") == 0).select(docs.columns)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict for every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    judged = with_verdict(docs, fit_rules(docs, load(spark, sf_dir, "labels")))
    stats = F.col("quality_stats")
    return judged.select(
        "doc_id",
        *[stats[s].alias(s) for s in STATS[:5]],
        (F.col("quality_rule") == -1).alias("base_failed"),
        (F.col("quality_rule") == 0).alias("kept"),
        F.col("quality_rule").alias("rule"),
    )
