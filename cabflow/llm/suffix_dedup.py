"""Removal of repeated byte strings with a distributed, prefix-aware suffix sort.

A byte goes when a string of ``length`` bytes that covers it also starts earlier in
the corpus. Not every suffix has to be sorted for that: each window of ``length``
bytes names one of its positions, the leftmost with the smallest hash of ``gram``
bytes, as its anchor. Equal windows have equal anchors, and neighbouring windows
share one, so the corpus is covered by anchors with spans of windows.

1. Distributed duplicate detection: grams that occur at one anchor only cannot
   repeat and are never exchanged.
2. Of anchors whose whole span is the same string only the first takes part in the
   sort; the others repeat it as a whole.
3. The suffixes at the remaining anchors are sorted in each task, front-coded (the
   length of the prefix shared with the one before, and the rest) and exchanged by
   gram. Each receiver merges its runs with a loser tree that keeps the known common
   prefixes: it compares lengths first and bytes only beyond them. Neighbours that
   share a gram are then compared window by window, on the bytes.
4. A gram with over ``max_group`` different spans is not merged in one task: its
   windows are spread by their 128-bit hash instead.

Defined results: documents are ordered by doc_id, those without one last, and rows
that share a doc_id by the hash of their text; rows equal in both are one document
and get the same answer; a null text is empty; texts under ``length`` bytes and
empty tables lose nothing. Other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, written

LENGTH = 100
GRAM = 32
MAX_GROUP = 2_000
SPANS_PER_BUCKET = 100_000
# Long texts are cut into pieces of this many windows; memory stays bounded.
PIECE = 1 << 21
# Ids are broadcast up to this counted number of rows, joined by shuffle beyond it.
BROADCAST_IDS = 1_000_000

_RNG = np.random.default_rng(100)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = _RNG.integers(1, 2**63, 16, dtype=np.uint64) | np.uint64(1)


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at every position (gram is a power of two)."""
    h = _BYTE[raw]
    size, k = 1, 0
    while size < gram:
        h = h[:-size] * _STEP[k] + h[size:]
        size, k = 2 * size, k + 1
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors as (position, first window, last window, gram hash), piece by piece."""
    width = length - gram + 1
    for begin in range(0, max(0, len(raw) - length + 1), PIECE):
        part = raw[begin : begin + PIECE + length - 1]
        h = gram_hashes(part, gram)
        key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        if size < width:
            key = np.minimum(key[: len(key) - (width - size)], key[width - size :])
        at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:] - 1, len(at) - 1)
        yield at[first] + begin, first + begin, last + begin, h[at[first]].view(np.int64)


def bytes_of(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def grams_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc, th, grams: the distinct anchor grams, those that repeat inside the document twice."""
    for batch in batches:
        out = []
        for text in batch["text"]:
            found = [g for _, _, _, g in anchors(np.frombuffer(bytes_of(text), dtype=np.uint8))]
            if not found:
                out.append(np.zeros(0, dtype=np.int64))
                continue
            values, counts = np.unique(np.concatenate(found), return_counts=True)
            out.append(np.concatenate([values, values[counts > 1]]))
        yield pd.DataFrame({"doc": batch["doc"], "th": batch["th"], "grams": out})


# --- runs and their merge -----------------------------------------------------


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    most = min(len(a), len(b))
    k = start
    while k < most and a[k : k + 32] == b[k : k + 32]:
        k += 32
    k = min(k, most)
    while k < most and a[k] == b[k]:
        k += 1
    return k


def front_coded(entries: list[tuple[bytes, tuple]]) -> bytes:
    """A sorted run: shared prefix lengths, the rests, and what belongs to them."""
    entries.sort(key=lambda e: e[0])
    shared, rests, owners = [], [], []
    before = b""
    for suffix, owner in entries:
        k = common_prefix(before, suffix, 0)
        shared.append(k)
        rests.append(suffix[k:])
        owners.append(owner)
        before = suffix
    return pickle.dumps((shared, rests, owners), protocol=5)


class Run:
    """A front-coded run, read one suffix at a time."""

    def __init__(self, coded: bytes):
        self.shared, self.rests, self.owners = pickle.loads(coded)
        self.at = -1
        self.suffix = b""
        self.prefix = 0  # shared with the last suffix that left the tree
        self.step()

    def step(self) -> None:
        self.at += 1
        if self.at < len(self.shared):
            self.prefix = self.shared[self.at]
            self.suffix = self.suffix[: self.prefix] + self.rests[self.at]
        else:
            self.prefix = -1

    @property
    def done(self) -> bool:
        return self.at >= len(self.shared)


def merge_runs(runs: list[Run]) -> Iterator[tuple[bytes, int, tuple]]:
    """(suffix, prefix shared with the one before, owner) in order, by a loser tree.

    Every run in the tree knows the prefix it shares with the last suffix that
    left. The longer prefix is the smaller suffix; only on a tie are bytes
    compared, from that prefix on, and the loser keeps what it shares with the
    winner.
    """
    n = len(runs)
    if not n:
        return
    losers = [-1] * n

    def beats(x: int, y: int) -> bool:
        """Whether run x goes first; sets the prefix of the one that does not."""
        a, b = runs[x], runs[y]
        if a.done or b.done:
            return b.done and not (a.done and x > y)
        if a.prefix != b.prefix:
            return a.prefix > b.prefix
        k = common_prefix(a.suffix, b.suffix, a.prefix)
        first = (a.suffix[k:], x) < (b.suffix[k:], y)
        (b if first else a).prefix = k
        return first

    def play(node: int) -> int:
        if node >= n:
            return node - n
        left, right = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (left, right) if beats(left, right) else (right, left)
        return winner

    for run in runs:
        run.prefix = min(run.prefix, 0) if run.done else 0
    top = play(1) if n > 1 else 0
    while not runs[top].done:
        run = runs[top]
        yield run.suffix, run.prefix, run.owners[run.at]
        run.step()
        node = (top + n) // 2
        while node >= 1:
            if not beats(top, losers[node]):
                top, losers[node] = losers[node], top
            node //= 2


def repeated_windows(group: list[tuple[bytes, tuple]], length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """(doc, th, start, end) of the windows in a group of one gram that start earlier elsewhere.

    An owner is (doc, th, position, last window, bytes before the position).
    """
    first: dict[bytes, tuple[int, int, int]] = {}
    rows = []
    for suffix, (doc, th, at, last, before) in group:
        whole = before + suffix
        begin = at - len(before)
        for start in range(begin, last + 1):
            window = whole[start - begin : start - begin + length]
            place = (doc, th, start)
            known = first.get(window)
            if known is None or place < known:
                first[window] = place
            rows.append((window, place))
    for window, place in rows:
        if first[window] != place:
            yield (*place, place[2] + length)


def merge_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """Merge the runs of one bucket and compare the windows of neighbours with one gram."""
    out: list[tuple[int, int, int, int]] = []
    group: list[tuple[bytes, tuple]] = []
    for suffix, shared, owner in merge_runs([Run(r) for r in frame["run"]]):
        if shared < GRAM and group:
            if len(group) > 1:
                out += repeated_windows(group)
            group = []
        group.append((suffix, owner))
    if len(group) > 1:
        out += repeated_windows(group)
    return joined_spans(out)


def joined_spans(rows: list[tuple[int, int, int, int]]) -> pd.DataFrame:
    """Overlapping and touching spans of a document as one."""
    out: list[list[int]] = []
    for doc, th, start, end in sorted(rows):
        if out and out[-1][:2] == [doc, th] and start <= out[-1][3]:
            out[-1][3] = max(out[-1][3], end)
        else:
            out.append([doc, th, start, end])
    return pd.DataFrame(out, columns=["doc", "th", "start", "end"], dtype="int64")


# --- the steps over the corpus ------------------------------------------------

_SPAN = "doc long, th long, start long, end long"


def _digest(raw: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _held_anchors(text: str, grams: np.ndarray) -> Iterator[tuple[bytes, np.ndarray]]:
    """The text's bytes and its anchors with a repeated gram: rows (position, first, last, gram)."""
    raw = bytes_of(text)
    for at, first, last, g in anchors(np.frombuffer(raw, dtype=np.uint8)):
        mine = np.isin(g, grams)
        yield raw, np.column_stack([at[mine], first[mine], last[mine], g[mine]])


def spans_of_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc, th, at, first, last, gram and the 128-bit hash of the whole span."""
    names = ["doc", "th", "at", "first", "last", "gram", "h1", "h2"]
    for batch in batches:
        parts = [np.zeros((0, len(names)), dtype=np.int64)]
        for doc, th, text, grams in zip(batch["doc"], batch["th"], batch["text"], batch["grams"]):
            for raw, rows in _held_anchors(text, np.asarray(grams)):
                spans = zip(rows[:, 1].tolist(), (rows[:, 2] + LENGTH).tolist())
                digests = b"".join([hashlib.blake2b(raw[f:z], digest_size=16).digest() for f, z in spans])
                key = np.broadcast_to(np.array([doc, th], dtype=np.int64), (len(rows), 2))
                parts.append(np.hstack([key, rows, np.frombuffer(digests, dtype="<i8").reshape(-1, 2)]))
        yield pd.DataFrame(np.concatenate(parts), columns=names)


def _sorted_runs(buckets: int):
    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            entries: dict[int, list] = {}
            for doc, th, text, spans in zip(batch["doc"], batch["th"], batch["text"], batch["spans"]):
                raw = bytes_of(text)
                for s in spans:
                    owner = (doc, th, s["at"], s["last"], raw[s["first"] : s["at"]])
                    entries.setdefault(s["gram"] % buckets, []).append((raw[s["at"] : s["last"] + LENGTH], owner))
            if entries:
                yield pd.DataFrame({"bucket": list(entries), "run": [front_coded(e) for e in entries.values()]})

    return runs


def _spread_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, th, text, spans in zip(batch["doc"], batch["th"], batch["text"], batch["spans"]):
            raw = bytes_of(text)
            out += [
                (*_digest(raw[k : k + LENGTH]), doc, th, k) for s in spans for k in range(s["first"], s["last"] + 1)
            ]
        yield pd.DataFrame(out, columns=["h1", "h2", "doc", "th", "start"], dtype="int64")


def _kept_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc, th, text, spans in zip(batch["doc"], batch["th"], batch["text"], batch["spans"]):
            raw = bytes_of(text)
            runs = joined_spans([(0, 0, s["start"], s["end"]) for s in spans])
            digest, at = hashlib.sha256(), 0
            for start, end in zip(runs["start"].tolist(), runs["end"].tolist()):
                digest.update(raw[at:start])
                at = end
            digest.update(raw[at:])
            out.append((doc, th, int((runs["end"] - runs["start"]).sum()), len(runs), digest.hexdigest()))
        yield pd.DataFrame(out, columns=["doc", "th", "n_removed", "n_spans", "kept_sha256"])


def keyed(docs: DataFrame) -> DataFrame:
    """doc, th, text: the key that orders documents (th is 0 where ids alone are a key)."""
    ids = docs.select(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("d")).first()
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    th = F.lit(0).cast("long") if ids["n"] == ids["d"] else F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", doc.alias("doc"), th.alias("th"), F.coalesce("text", F.lit("")).alias("text"))


def repeated_spans(rows: DataFrame, max_group: int = MAX_GROUP) -> tuple[DataFrame, DataFrame]:
    """The held texts, and doc, th, start, end of what repeats in them (spans may overlap)."""
    rows = rows.select("doc", "th", "text")
    grams = rows.filter(F.octet_length("text") >= LENGTH).mapInPandas(grams_of, "doc long, th long, grams array<long>")
    each = grams.select("doc", "th", F.explode("grams").alias("gram"))
    twice = each.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("gram")
    # A gram met twice in one document stands there twice: once is enough from here on.
    once = grams.select("doc", "th", F.explode(F.array_distinct("grams")).alias("gram"))
    lists = once.join(twice, "gram").groupBy("doc", "th").agg(F.collect_list("gram").alias("grams"))
    lists = written(lists)
    n = lists.count()
    ids = lists.select(F.col("doc").alias("__d"), F.col("th").alias("__t"))
    chosen = rows.join(F.broadcast(ids), (F.col("doc") == F.col("__d")) & (F.col("th") == F.col("__t")), "left_semi") if n <= BROADCAST_IDS else rows
    held = written(chosen.dropDuplicates(["doc", "th"]).join(lists, ["doc", "th"]) if n else chosen.limit(0).join(lists, ["doc", "th"]))

    fields = "doc long, th long, at long, first long, last long, gram long, h1 long, h2 long"
    spans = held.mapInPandas(spans_of_anchors, fields)
    classes = spans.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "th", "first", "last", "at")).alias("low"), F.min("gram").alias("gram"), F.count(F.lit(1)).alias("c")
    )
    classes = written(classes)
    several = classes.filter("c > 1").select("h1", "h2", "low")
    again = spans.join(several, ["h1", "h2"]).filter(
        (F.col("doc") != F.col("low.doc")) | (F.col("th") != F.col("low.th")) | (F.col("first") != F.col("low.first"))
    )
    whole = again.select("doc", "th", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("end"))

    # First spans that share their gram with a different span: only those are sorted.
    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = classes.select("gram", "low.*").join(mixed, "gram")
    firsts = firsts.groupBy("doc", "th").agg(F.collect_list(F.struct("at", "first", "last", "gram", "n")).alias("spans"))
    firsts = written(firsts)
    have = firsts.agg(
        F.sum(F.size("spans")).alias("size"), F.max(F.array_max(F.transform("spans", lambda x: x["n"]))).alias("most")
    ).first()

    def texts(wanted) -> DataFrame:
        """The texts with their first spans of the wanted grams."""
        some = firsts.withColumn("spans", F.filter("spans", wanted)).filter(F.size("spans") > 0)
        return held.select("doc", "th", "text").join(some, ["doc", "th"])

    partitions = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, -(-(have["size"] or 0) // SPANS_PER_BUCKET), partitions)
    runs = texts(lambda x: x["n"] <= max_group).mapInPandas(_sorted_runs(buckets), "bucket long, run binary")
    spans = whole.union(runs.groupBy("bucket").applyInPandas(merge_bucket, _SPAN))
    if (have["most"] or 0) > max_group:
        windows = texts(lambda x: x["n"] > max_group).mapInPandas(
            _spread_windows, "h1 long, h2 long, doc long, th long, start long"
        )
        lowest = windows.groupBy("h1", "h2").agg(
            F.min(F.struct("doc", "th", "start")).alias("low"), F.count(F.lit(1)).alias("c")
        )
        spread = windows.join(lowest.filter("c > 1"), ["h1", "h2"]).filter(
            (F.col("doc") != F.col("low.doc")) | (F.col("th") != F.col("low.th")) | (F.col("start") != F.col("low.start"))
        )
        spans = spans.union(spread.select("doc", "th", "start", (F.col("start") + LENGTH).alias("end")))
    return held, spans


def deduplicate(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = keyed(docs)
    held, spans = repeated_spans(rows, max_group)
    per = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    schema = "doc long, th long, n_removed long, n_spans long, kept_sha256 string"
    changed = held.select("doc", "th", "text").join(per, ["doc", "th"]).mapInPandas(_kept_part, schema)
    base = rows.select(
        "doc_id", "doc", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")
    )
    none = F.lit(0).cast("long")
    return base.join(changed, ["doc", "th"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes removed from all documents."""
    return deduplicate(load(spark, sf_dir, "documents"))
