"""Removal of passages that stand in an earlier document, with suffix automata of
reference shards.

A window is ``WINDOW`` consecutive words. A word goes when a window that covers it also
starts in a document with a smaller id; windows are judged on the input.

1. Every window names one of its runs of ``GRAM`` words as its anchor, the leftmost with the
   smallest hash, so equal windows have equal anchors. Only anchors that stand in two
   documents can lie in a repeated window. An anchor with more than ``MAX_SPANS``
   different surroundings is passed over by all windows that hold any other run.
2. The reference is the text around such anchors, each different surrounding once, from
   its first document. An anchor's shard follows from the first document that holds it,
   so that a passage stays together; first documents with many surroundings are split.
3. Each shard becomes a suffix automaton of words whose states know the first document
   of their strings. The automata are broadcast, ``BROADCAST_BYTES`` a round, and the
   documents' texts around the anchors stream through them: the matching statistics,
   cut at ``WINDOW`` words, tell for each position whether the window that ends there
   stands in an earlier document. Maximal runs of such windows are the spans removed.

Hashes only choose what is compared; windows are compared word by word.

Defined results: documents are ordered by doc_id, those without one come after all
others and do not repeat each other, nor do rows that share an id; a null text has no
words; texts under ``WINDOW`` words and empty tables lose nothing. Other columns are
ignored. Whole texts are read; a long text is anchored in pieces, its windows are all seen.
"""

from __future__ import annotations

import gc
import hashlib
import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, small_side, written
from cabflow.llm.suffix_dedup import keyed
from cabflow.session import shared_path

WINDOW = 50
GRAM = 24
MAX_SPANS = 5_000
# The anchors are chosen anew without the crowded ones this often at most.
ROUNDS_OF_ANCHORS = 3
CROWDED = 1_000_000
# Reference spans of a shard, and bytes of automata that a round broadcasts.
SPANS_PER_SHARD = 2_000
BROADCAST_BYTES = 32 << 20
# Ids, grams and spans are broadcast up to this counted number (tens of bytes each), joined by shuffle beyond it.
BROADCAST_IDS = 1_000_000
# Bytes of texts that are hashed at once, and words that are anchored at once.
BYTES_AT_ONCE = 1 << 20
WORDS_AT_ONCE = 1 << 19

_RNG = np.random.default_rng(13)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])


def _powers(base: int, n: int) -> np.ndarray:
    return np.append(np.uint64(1), np.cumprod(np.full(n, base, dtype=np.uint64)))


# Odd numbers have inverses modulo 2**64, so sums from the start of a text can be rebased.
_POWERS = [_powers(b, n) for b, n in ((0x9E3779B97F4A7C15, BYTES_AT_ONCE), (0xD1342543DE82EF95, WORDS_AT_ONCE + WINDOW))]
_INVERSE = [_powers(pow(b, -1, 2**64), n) for b, n in ((0x9E3779B97F4A7C15, BYTES_AT_ONCE), (0xD1342543DE82EF95, WORDS_AT_ONCE + WINDOW))]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(30))


def _range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of what lies between ``start`` and ``end`` by the running sums from 0."""
    plain = (sums[end] - sums[start]) * _INVERSE[which][start]
    return _mixed(plain + (end - start).astype(np.uint64))


def texts_at_once(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, bounds of the texts in them), some texts at a time; a long one stands alone."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    bounds = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + BYTES_AT_ONCE, side="right")) - 1)
        yield i, data[bounds[i] : bounds[j]], (bounds[i : j + 1] - bounds[i]).astype(np.int64)
        i = j


def word_edges(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; none crosses a bound."""
    word = ~_SPACE[data]
    before, after = np.append(False, word[:-1]), np.append(word[1:], False)
    before[bounds[bounds < len(data)]] = False
    after[bounds[bounds > 0] - 1] = False
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + BYTES_AT_ONCE, side="right"))
        if j <= i:  # a word longer than that
            digest = hashlib.blake2b(data[base : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        part = data[base : ends[j - 1]]
        sums = np.append(np.uint64(0), np.cumsum(_BYTE[part] * _POWERS[0][: len(part)]))
        out[i:j] = _range_hashes(sums, starts[i:j] - base, ends[i:j] - base, 0)
        i = j
    return out


def anchors(
    words: np.ndarray, stops: np.ndarray, crowded: np.ndarray, window: int = WINDOW, gram: int = GRAM
) -> Iterator[tuple]:
    """(gram, span hash, first window, last window) of the anchors, piece by piece.

    ``stops`` is the end of each word's text. The span of an anchor reaches from its
    first window's start to its last window's end.
    """
    width = window - gram + 1
    for begin in range(0, len(words) - window + 1, WORDS_AT_ONCE):
        part = words[begin : begin + WORDS_AT_ONCE + window - 1]
        sums = np.append(np.uint64(0), np.cumsum(part * _POWERS[1][: len(part)]))
        at = np.arange(len(part) - gram + 1)
        grams = _range_hashes(sums, at, at + gram, 1)
        key = ((grams >> np.uint64(33)) << np.uint64(32)) | at.astype(np.uint64)
        if len(crowded):
            key |= np.isin(grams.view(np.int64), crowded).astype(np.uint64) << np.uint64(63)
        size = 1
        while 2 * size <= width:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < width:
            key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
        at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        whole = np.arange(begin, begin + len(at)) + window <= stops[begin : begin + len(at)]
        change = at[1:] != at[:-1]
        first = np.flatnonzero(whole & np.append(True, change | ~whole[:-1]))
        last = np.flatnonzero(whole & np.append(change | ~whole[1:], True))
        spans = _range_hashes(sums, first, last + window, 1)
        yield grams[at[first]].view(np.int64), spans.view(np.int64), first + begin, last + begin


_ANCHOR = "doc long, th long, gram long, span long, first long, last long"


def anchor_rows(rows: DataFrame, crowded: np.ndarray, window: int) -> DataFrame:
    """doc, th, gram, span, first and last window of every anchor of every text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, th = (batch.column(i).to_numpy() for i in (0, 1))
            for begin, data, bounds in texts_at_once(batch.column(2)):
                starts, ends = word_edges(data, bounds)
                texts = np.searchsorted(starts, bounds)  # first word of each text
                words = word_hashes(data, starts, ends)
                stops = np.repeat(texts[1:], np.diff(texts))
                for gram, span, first, last in anchors(words, stops, crowded, window):
                    own = np.searchsorted(texts, first, side="right") - 1
                    columns = [doc[begin + own], th[begin + own], gram, span, first - texts[own], last - texts[own]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = [c.split()[0] for c in _ANCHOR.split(", ")]
    some = rows.filter(F.octet_length("text") >= 2 * window - 1)
    return some.select("doc", "th", F.col("text").cast("binary")).mapInArrow(find, _ANCHOR)


# --- automata -----------------------------------------------------------------


class Automaton:
    """Suffix automaton of word sequences added in the order of their documents."""

    def __init__(self):
        self.words: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [0]

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of ``q`` for its strings that extend those of ``p``."""
        go, link = self.go, self.link
        copy = len(go)
        go.append(dict(go[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        self.first.append(self.first[q])
        while p >= 0 and go[p].get(word) == q:
            go[p][word] = copy
            p = link[p]
        link[q] = copy
        return copy

    def add(self, words: list[bytes], doc: int) -> None:
        """Add one sequence of a document that is not before those added already."""
        go, link, length, first, numbers = self.go, self.link, self.length, self.first, self.words
        last = 0
        for w in words:
            word = numbers.setdefault(w, len(numbers))
            q = go[last].get(word)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, word, q)
                continue
            new = len(go)
            go.append({})
            length.append(length[last] + 1)
            link.append(0)
            first.append(doc)
            p = last
            while p >= 0:
                steps = go[p]
                if word in steps:
                    q = steps[word]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
                    break
                steps[word] = new
                p = link[p]
            last = new

    def packed(self, window: int = WINDOW) -> bytes:
        """Arrays of the states and their steps, compressed; lengths matter up to ``window`` only."""
        sizes = np.fromiter(map(len, self.go), np.int32, len(self.go))
        n = int(sizes.sum())
        steps = np.fromiter(chain.from_iterable(self.go), np.int32, n)
        goals = np.fromiter(chain.from_iterable(g.values() for g in self.go), np.int32, n)
        docs, first = np.unique(np.array(self.first, dtype=np.int64), return_inverse=True)
        states = np.arange(len(sizes), dtype=np.int32)
        parts = {
            "words": b" ".join(self.words),
            "sizes": sizes,
            "steps": steps,
            "ahead": goals - np.repeat(states, sizes),  # mostly 1
            "links": np.array(self.link, dtype=np.int32),
            "lengths": np.minimum(self.length, window).astype(np.int32),
            "docs": docs,
            "first": first.astype(np.int32),
        }
        return zstandard.compress(pickle.dumps(parts, protocol=5), 1)


class Reader:
    """A broadcast automaton, ready for texts to stream through."""

    def __init__(self, packed: bytes):
        parts = pickle.loads(zstandard.decompress(packed))
        sizes, steps = parts["sizes"], parts["steps"]
        states = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
        goals = parts["ahead"] + states
        self.words = {w: i for i, w in enumerate(parts["words"].split(b" "))}
        # Most states have one step: that of a list. The steps of the others are in a dictionary.
        single = sizes == 1
        of_single = np.repeat(single, sizes)
        step, goal = np.full(len(sizes), -1), np.zeros(len(sizes), dtype=np.int64)
        step[single], goal[single] = steps[of_single], goals[of_single]
        self.step, self.goal = step.tolist(), goal.tolist()
        rest = ~of_single
        self.more = dict(zip(((states[rest] << 32) | steps[rest]).tolist(), goals[rest].tolist()))
        self.link, self.length = parts["links"].tolist(), parts["lengths"].tolist()
        self.first = parts["docs"][parts["first"]].tolist()

    def spans(self, text: list[bytes], doc: int, window: int = WINDOW) -> list[tuple[int, int]]:
        """Maximal runs of windows of ``text`` that stand in a document before ``doc``."""
        step, goals, more, words = self.step, self.goal, self.more.get, self.words.get
        link, length, first = self.link, self.length, self.first
        out: list[tuple[int, int]] = []
        state = matched = 0
        for at, w in enumerate(text, 1):
            word = words(w)
            if word is None:
                state = matched = 0
                continue
            goal = goals[state] if step[state] == word else more((state << 32) | word)
            if goal is None:
                while goal is None and state:
                    state = link[state]
                    goal = goals[state] if step[state] == word else more((state << 32) | word)
                if goal is None:
                    matched = 0
                    continue
                matched = length[state]
            state = goal
            matched += 1
            if matched >= window:
                matched = window
                while length[link[state]] >= window:
                    state = link[state]
                if first[state] < doc:
                    begin = at - window
                    if out and begin <= out[-1][1]:
                        out[-1] = (out[-1][0], at)
                    else:
                        out.append((begin, at))
        return out


@contextmanager
def _no_collection():
    """Millions of small dictionaries without a cycle: looking for cycles would take most of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _automaton_of(rows: pd.DataFrame) -> pd.DataFrame:
    automaton = Automaton()
    rows = rows.sort_values(["doc", "th", "start"])
    with _no_collection():
        for doc, text in zip(rows["doc"], rows["text"]):
            automaton.add(text.split(b" "), int(doc))
        packed = automaton.packed()
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "size": [len(packed)], "packed": [packed]})


# --- the job ------------------------------------------------------------------


def spans_of_anchors(rows: DataFrame, window: int, max_spans: int) -> tuple[DataFrame, DataFrame]:
    """The anchors that stand in two documents, and their spans as (gram, span, lowest, home).

    ``lowest`` is the first document of the span, ``home`` that of the gram. Most grams
    stand in one document; their anchors go no further.
    """
    crowded = np.zeros(0, dtype=np.int64)
    for left in reversed(range(ROUNDS_OF_ANCHORS)):
        found = written(anchor_rows(rows, crowded, window))
        grams = found.groupBy("gram").agg(F.min("doc").alias("home"), F.max("doc").alias("highest"))
        grams = written(grams.filter("home < highest").select("gram", "home"))
        known = grams.select("gram")
        found = found.join(F.broadcast(known) if grams.count() <= BROADCAST_IDS else known, "gram", "left_semi")
        spans = written(found.groupBy("gram", "span").agg(F.min("doc").alias("lowest")).join(grams, "gram"))
        if not left:
            break
        more = spans.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_spans)
        more = more.orderBy(F.desc("n"), "gram").select("gram").limit(CROWDED)
        more = np.array([r[0] for r in more.collect()], dtype=np.int64)  # a crowded gram is one in max_spans at most
        if not len(np.setdiff1d(more, crowded)):
            break
        crowded = np.union1d(crowded, more)
    return found, spans


def sharded(spans: DataFrame) -> DataFrame:
    """Add the shard: by the gram's home, or by home and gram where a home has many spans."""
    homes = spans.groupBy("home").agg(F.count(F.lit(1)).alias("n"))
    size = homes.agg(F.sum("n").alias("spans"), F.count_if(F.col("n") > SPANS_PER_SHARD).alias("large")).first()
    large = homes.filter(F.col("n") > SPANS_PER_SHARD)
    large = large.select("home", F.ceil(F.col("n") / SPANS_PER_SHARD).alias("parts"))
    part = F.coalesce(F.pmod("gram", "parts"), F.lit(0))
    shards = max(1, -(-(size["spans"] or 0) // SPANS_PER_SHARD))
    out = spans.join(small_side(large, size["large"]), "home", "left")
    return out.withColumn("shard", F.pmod(F.xxhash64("home", part), F.lit(shards)).cast("int")).drop("parts")


_REGION = "shard int, doc long, th long, is_query boolean, start long, text binary"


def regions(held: DataFrame, window: int) -> DataFrame:
    """The text around repeated anchors, in runs of the same shard: as reference, as query or both."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, th, text, lists in zip(batch["doc"], batch["th"], batch["text"], batch["anchors"]):
                words = text.split()
                found = sorted({(a["first"], a["last"], a["shard"], a["lowest"], a["home"]) for a in lists})
                for is_query in (False, True):
                    run = None
                    for first, last, shard, lowest, home in found:
                        if not (home < doc if is_query else lowest == doc):
                            continue
                        if run and run[0] == shard and run[2] + 1 == first:
                            run[2] = last
                            continue
                        if run:
                            out.append((run[0], doc, th, is_query, run[1], b" ".join(words[run[1] : run[2] + window])))
                        run = [shard, first, last]
                    if run:
                        out.append((run[0], doc, th, is_query, run[1], b" ".join(words[run[1] : run[2] + window])))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _REGION.split(", ")])

    return held.withColumn("text", F.col("text").cast("binary")).mapInPandas(cut, _REGION)


def streamed(texts: DataFrame, automata: DataFrame, window: int, limit: int) -> DataFrame:
    """doc, th, start, end of the spans that the automata find, one broadcast a round."""
    spark = texts.sparkSession
    texts = texts.filter("is_query").hint("rebalance", "shard").sortWithinPartitions("shard")
    texts = written(texts.drop("is_query"))
    rounds: list[tuple[int, int]] = []
    held = limit
    for r in automata.select("shard", "size").orderBy("shard").toLocalIterator():  # a row a shard
        if held + r["size"] > limit:
            rounds.append((r["shard"], r["shard"]))
            held = 0
        rounds[-1] = (rounds[-1][0], r["shard"])
        held += r["size"]
    schema = "doc long, th long, start long, end long"
    path = shared_path(spark, f"substring-{uuid.uuid4().hex}")
    spark.createDataFrame([], schema).write.parquet(path)
    for low, high in rounds:
        mine = F.col("shard").between(low, high)
        rows = automata.filter(mine).select("shard", "packed").toArrow().to_pylist()  # bounded by ``limit``
        shared = spark.sparkContext.broadcast({r["shard"]: r["packed"] for r in rows})
        found = texts.filter(mine).mapInPandas(_stream_through(shared, window), schema)
        found.write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.schema(schema).parquet(path)


def _stream_through(shared, window: int):
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, reader = None, None
        for batch in batches:
            out = []
            for own, doc, th, start, text in zip(batch["shard"], batch["doc"], batch["th"], batch["start"], batch["text"]):
                if own != shard:
                    shard, reader = own, Reader(shared.value[own])
                out += [(doc, th, start + b, start + e) for b, e in reader.spans(text.split(b" "), doc, window)]
            yield pd.DataFrame(out, columns=["doc", "th", "start", "end"], dtype="int64")

    return stream


def repeated_spans(
    rows: DataFrame, window: int = WINDOW, max_spans: int = MAX_SPANS, limit: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame]:
    """The texts that share an anchor with another document (of :func:`keyed` rows), and
    doc, th, start, end in words of what they repeat (spans may overlap)."""
    found, spans = spans_of_anchors(rows.select("doc", "th", "text"), window, max_spans)
    lists = found.join(written(sharded(spans)), ["gram", "span"]).groupBy("doc", "th").agg(
        F.collect_list(F.struct("first", "last", "shard", "lowest", "home")).alias("anchors")
    )
    lists = written(lists)
    chosen, n = rows.select("doc", "th", "text"), lists.count()
    if n <= BROADCAST_IDS:
        chosen = chosen.join(F.broadcast(lists.select("doc", "th")), ["doc", "th"], "left_semi")
    held = written(chosen.join(lists, ["doc", "th"]))
    if held.count() > n:  # rows that are equal in id and text are one document
        held = written(held.dropDuplicates(["doc", "th"]))
    texts = written(regions(held, window))
    automata = texts.filter("NOT is_query").groupBy("shard")
    automata = written(automata.applyInPandas(_automaton_of, "shard int, size long, packed binary"))
    return held.select("doc", "th", "text"), streamed(texts, automata, window, limit)


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining spans as one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _without(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, th, text, spans in zip(batch["doc"], batch["th"], batch["text"], batch["spans"]):
            words, kept, at = text.split(), [], 0
            runs = joined([(s["start"], s["end"]) for s in spans])
            for start, end in runs:
                kept += words[at:start]
                at = end
            kept += words[at:]
            out.append((doc, th, sum(e - s for s, e in runs), runs, b" ".join(kept)))
        yield pd.DataFrame(out, columns=["doc", "th", "n_removed", "removed", "kept"])


def changed_texts(held: DataFrame, spans: DataFrame) -> DataFrame:
    """doc, th, n_removed, removed spans and kept words of the texts that lose words."""
    per = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    per = F.broadcast(per) if spans.count() <= BROADCAST_IDS else per  # a span is two numbers
    schema = "doc long, th long, n_removed long, removed array<struct<start: long, end: long>>, kept binary"
    both = held.withColumn("text", F.col("text").cast("binary")).join(per, ["doc", "th"])
    return both.mapInPandas(_without, schema).withColumn("kept", F.col("kept").cast("string"))


def spaced(rows: DataFrame) -> DataFrame:
    """Add ``plain``, the words of the text with one space between them, and ``n_words``."""
    rows = rows.withColumn("plain", F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")))
    between = F.length("plain") - F.length(F.replace("plain", F.lit(" "), F.lit("")))
    return rows.withColumn("n_words", F.when(F.col("plain") == "", 0).otherwise(between + 1).cast("long"))


def without_repeats(docs: DataFrame, window: int = WINDOW, **bounds) -> DataFrame:
    """doc_id, n_words, n_removed, removed (spans in words) and the kept words of every document."""
    rows = keyed(docs)
    changed = changed_texts(*repeated_spans(rows, window, **bounds))
    base = spaced(rows).select("doc_id", "doc", "th", "n_words", "plain")
    out = base.join(changed, ["doc", "th"], "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.array()).alias("removed"),
        F.coalesce("kept", "plain").alias("kept"),
    )


def digests(docs: DataFrame, window: int = WINDOW, **bounds) -> DataFrame:
    """doc_id, n_words, n_removed and the hash of the kept words; texts are hashed where they are."""
    rows = keyed(docs)
    changed = changed_texts(*repeated_spans(rows, window, **bounds))
    changed = changed.select("doc", "th", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
    base = spaced(rows).select("doc_id", "doc", "th", "n_words", F.sha2("plain", 256).alias("sha"))
    return base.join(changed, ["doc", "th"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words that stand in an earlier document removed from all documents."""
    return digests(load(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS no, doc_id, coalesce(doc_id, 9223372036854775807) AS doc,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
), windows AS (
  SELECT no, doc, s, md5(array_to_string(words[s:s + 49], ' ')) AS h
  FROM (SELECT no, doc, words, unnest(range(1, len(words) - 48)) AS s FROM docs WHERE len(words) >= 50)
), earliest AS (
  SELECT h, min(doc) AS lowest FROM windows GROUP BY h HAVING min(doc) < max(doc)
), gone AS (
  SELECT DISTINCT no, s + o AS i
  FROM windows JOIN earliest USING (h), (SELECT unnest(range(50)) AS o)
  WHERE doc > lowest
), per AS (
  SELECT no, list(i) AS gone FROM gone GROUP BY no
), kept AS (
  SELECT no, string_agg(word, ' ' ORDER BY i) AS kept
  FROM (SELECT no, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs)
  ANTI JOIN gone USING (no, i)
  GROUP BY no
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(len(p.gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN per p USING (no) LEFT JOIN kept k USING (no)
"""
