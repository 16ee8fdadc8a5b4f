"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Fixed formats (e-mail, IPv4, payment card, phone) are matched by pattern and checks
and always reported. High-recall generators propose further, overlapping spans:
written-out addresses, digit groups in any punctuation, colon-separated addresses,
letter-digit account numbers. Gradient-boosted trees score each candidate from its
format and its context, and a threshold per kind, calibrated on held-out candidates
for precision, selects the ones to redact; of overlapping ones the best stays.

There are no labels for personal data, so the trees learn from the formats that can
be verified: spans that pass the checks, and the same spans rewritten in other
styles, are positive; the same spans with broken digits or parts are negative, and so
are account numbers and colon addresses that fail theirs (mod 97, a parse). Any other
candidate may be the very data that is looked for, so it is unlabelled: only those
written like no positive that also score below nearly all held-out positives of their
kind (spies) serve as negatives, the rest neither trains nor calibrates.

Defined results: a null text is empty and has no spans; offsets are code points, the
end exclusive; repeated rows are reported each time; without any verified span to
learn from nothing is added; an empty table gives an empty result. Whole texts are
read; other columns pass through.
"""

from __future__ import annotations

import bisect
import ipaddress
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, small_batches, written

MIN_PRECISION = 0.98
RATE = 0.2  # of boosting
CONTEXT = 24
# Labels of training rows without a verifiable format.
UNLABELLED = -1.0
# Share of the held-out positives that may score below an unlabelled row that serves as a negative.
SPY_SHARE = 0.02

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("contact", "number", "address", "account")
KINDS = BASE_KINDS + ADDED_KINDS

# An e-mail is found from its @, an IP from the start of its digits: a pattern that starts
# again at every character of a long run would take the square of the run's length.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators of candidates, one per added kind.
GENERATORS = {
    "contact": re.compile(
        r"[\w.+-]{1,64}\s?(?:@|[\[({]\s?at\s?[\])}]|\bat\b|＠)\s?[\w-]{1,64}"
        r"(?:\s?(?:\.|[\[({]\s?dot\s?[\])}]|\bdot\b)\s?[\w-]{2,24}){1,4}",
        re.I,
    ),
    "number": re.compile(r"[+(]{0,2}[0-9](?:[\x20().\-/ ]{0,2}[0-9]){6,24}"),
    "address": re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{1,4}(?![\w:])|[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}"),
    "account": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
}
HINTS = {
    "contact": re.compile(r"mail|contact|write|reach|address|correo|adresse|schreib|écri", re.I),
    "number": re.compile(r"phone|tel|call|mobile|fax|card|visa|account|ssn|passport|konto|karte|carte|tarjeta|llam|appel", re.I),
    "address": re.compile(r"\bip\b|host|server|login|from|addr", re.I),
    "account": re.compile(r"iban|bank|account|konto|compte|cuenta", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else (v * 2 if v < 5 else v * 2 - 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def iban_ok(span: str) -> bool:
    """ISO 13616 check: the rearranged number is 1 modulo 97."""
    body = span.replace(" ", "")
    return 15 <= len(body) <= 34 and int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1


def colon_ok(span: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(span))
    except ValueError:
        return False


MAC = re.compile(r"[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}")


def verified(kind: int, span: str) -> float:
    """1 or 0 for candidates whose format can be checked, else UNLABELLED."""
    if KINDS[kind] == "account":
        return float(iban_ok(span))
    if KINDS[kind] == "address":
        if ":" in span:
            return UNLABELLED if MAC.fullmatch(span) else float(colon_ok(span))
        if any(int(g) > 255 for g in re.findall("[0-9]+", span)):
            return 0.0
    return UNLABELLED


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and domain.

    A local part holds no @, so it ends at one and reaches back over all its characters,
    but not into the match before.
    """
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        while domain and start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats that pass their checks, in order."""
    found = []
    found += [(start, 0, end) for start, end in emails(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m[0].split(".") if len(p.lstrip("0")) <= 3) and all(
            len(p.lstrip("0")) <= 3 for p in m[0].split(".")
        ):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


_ANY_DIGIT = re.compile("[0-9]")


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) proposed by every generator; spans of kinds overlap."""
    found = []
    if "@" in text or "＠" in text or "dot" in text or "DOT" in text or "Dot" in text:
        found += [(m.start(), 4, m.end()) for m in GENERATORS["contact"].finditer(text)]
    if _ANY_DIGIT.search(text):
        for kind in (5, 6, 7):
            found += [(m.start(), kind, m.end()) for m in GENERATORS[KINDS[kind]].finditer(text)]
        for start, kind, end in [c for c in found if c[1] == 7]:
            while not iban_ok(text[start:end]) and (cut := text.rfind(" ", start, end)) > 0:  # a capital word behind it
                end = cut
                if iban_ok(text[start:end]):
                    found.append((start, kind, end))
    return found


def span_features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span = text[start:end]
    digits = digits_of(span)
    groups = re.findall("[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    prev, nxt = before[-1:], after[:1]
    hint = HINTS[KINDS[kind]]
    values = [int(g) for g in groups if len(g) <= 4]
    tail = re.split(r"[^A-Za-z]+", span)[-1]
    return [
        kind,
        len(span),
        len(digits),
        letters,
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        len(groups[-1]) if groups else 0,
        luhn(digits) if len(digits) >= 8 else 0,
        digits[:1] == "0",
        span[:1] == "+",
        span.count("("),
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("/"),
        span.count(":"),
        "@" in span or "＠" in span,
        bool(re.search(r"[\[({]", span)) and letters > 0,
        len(tail),
        sum(v <= 255 for v in values) == len(groups) > 0,
        max(values, default=0),
        len(set(digits)) / max(1, len(digits)),
        sum(c.isupper() for c in span) / len(span),
        prev.isalnum(),
        nxt.isalnum(),
        prev in tuple("$€£#=%/.") and prev != "",
        nxt in tuple("%/=€$") and nxt != "",
        bool(hint.search(before)),
        bool(hint.search(after)),
        sum(c.isdigit() for c in before) / CONTEXT,
        sum(c.isdigit() for c in after) / CONTEXT,
        verified(kind, span),
    ]


# --- rewriting verified spans into training examples -------------------------


def colon_address(rng: np.random.Generator) -> str:
    groups = [int(g) for g in rng.integers(0, 2**16, 8)]
    groups[0] = int(rng.choice([0x2001, 0x2A02, 0x2600, 0xFE80]))
    if rng.random() < 0.5:  # zeros in the middle, written short
        groups[3:6] = [0, 0, 0]
    address = ipaddress.IPv6Address(sum(g << 16 * (7 - k) for k, g in enumerate(groups)))
    return address.compressed if rng.random() < 0.7 else address.exploded.upper()


def account_number(digits: str, rng: np.random.Generator) -> str:
    """An account number with valid check digits, plain or in groups of four."""
    country, size = [("DE", 18), ("ES", 20), ("FR", 23), ("GB", 18), ("NL", 14), ("BE", 12), ("AT", 16)][rng.integers(7)]
    body = (digits + "".join(map(str, rng.integers(0, 10, size))))[:size]
    if country in ("GB", "NL"):
        body = "".join(rng.choice(list("ABCDEGILNRST"), 4)) + body[4:]
    rest = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    whole = f"{country}{98 - rest:02d}{body}"
    return " ".join(whole[i : i + 4] for i in range(0, len(whole), 4)) if rng.random() < 0.6 else whole


def rewritten(kind: int, span: str, rng: np.random.Generator) -> list[tuple[int, str]]:
    """The same data in styles that the fixed formats miss: (candidate kind, text)."""
    digits = digits_of(span)
    if kind == 0:
        user, _, host = span.partition("@")
        if rng.random() < 0.5:  # not every address has digits or a subdomain
            user, host = re.sub("[0-9]+", "", user) or "me", re.sub("[0-9]+", "", host)
        if rng.random() < 0.5:
            host = ".".join(host.split(".")[-2:])
        at = rng.choice([" (at) ", " [at] ", " at ", "(at)", " @ "])
        dot = rng.choice([" dot ", "[dot]", " (dot) ", "."])
        return [(4, user + at + host.replace(".", dot))]
    if kind == 1:
        return [(6, span.replace(".", rng.choice(["[.]", "(.)", " . "]))), (6, colon_address(rng))]
    if kind == 2:
        mark = rng.choice([".", "/", "  "])
        return [(5, mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))), (7, account_number(digits, rng))]
    local = digits[-10:]
    style = rng.choice(["({0}) {1}-{2}", "{0}-{1}-{2}", "{0}.{1}.{2}", "00" + digits[:-10] + " {0} {1} {2}", "{0} {1} {2}", "({0}) {1} {2}"])
    return [(5, style.format(local[:3], local[3:6], local[6:]))]


def broken(kind: int, span: str, rng: np.random.Generator) -> list[tuple[int, str]]:
    """Look-alikes of the same shape that are no data of a person."""
    digits = digits_of(span)
    if kind == 0:
        user, _, host = span.partition("@")
        word = host.split(".")[0]
        sentence = f"{re.sub('[^a-z]+', '', user) or 'look'} at {word}. {rng.choice(['Then', 'The', 'We', 'It', 'and'])}"
        return [(4, user + " at " + word + "." + rng.choice(["12", "x1", "3rd"])), (4, sentence)]
    if kind == 1:
        address = colon_address(rng)
        cut = address.replace("::", ":").rpartition(":")[0]  # a group less and nothing that stands for it
        return [(6, span.rpartition(".")[0] + "." + str(rng.integers(256, 999))), (6, cut)]
    if kind == 2:
        last = (int(digits[-1]) + int(rng.integers(1, 10))) % 10
        account = account_number(digits, rng)
        at = len(account) - 1
        other = str((int(account[at]) + int(rng.integers(1, 10))) % 10)
        return [(5, span[:-1] + str(last)), (7, account[:at] + other)]
    year, month, day, hour = 1990 + rng.integers(0, 50), 1 + rng.integers(0, 12), 1 + rng.integers(0, 28), rng.integers(0, 24)
    date = rng.choice([f"{year}-{month:02d}-{day:02d} {hour:02d}", f"{day:02d}.{month:02d}.{year}", f"{day:02d}/{month:02d}/{year}"])
    mark = rng.choice([" ", "."])
    amount = mark.join([digits[-1], *(digits[i : i + 3] for i in range(0, 3 + 3 * int(rng.integers(1, 3)), 3))])
    return [(5, digits[-8:]), (5, digits * 2), (5, ".".join(digits)), (5, str(date)), (5, amount)]


def style_of(kind: int, span: str) -> float:
    """Number of the way a span is written: its marks and the lengths of its digit groups."""
    if kind == 4:
        marks = re.sub(r"\bdot\b", ".", re.sub(r"\bat\b", "@", span.lower()))
        user, at, host = re.split(r"([^\w]*[@＠][^\w]*)", marks, maxsplit=1) if re.search("[@＠]", marks) else ("", "", marks)
        style = at + "|" + "|".join(sorted(set(re.split(r"[\w-]+", host))))
    else:
        style = re.sub("[0-9]+" if kind == 6 else "[0-9]", "9", span)
    return float(zlib.crc32(f"{kind} {style}".encode("utf-8", "surrogatepass")))


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf(x)]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        while True:
            inner = feature[node] >= 0
            if not inner.any():
                return node
            rows = np.flatnonzero(inner)
            at = node[rows]
            node[rows] = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])


GRID_SHARES, GRID_OCTAVE = 128, 32


def grid(x: np.ndarray) -> np.ndarray:
    """Features as the trees see them: whole numbers up to 64, shares of 1/128, above 64 32 steps an octave.

    The grid is fixed, so the values of a feature are few whatever the number of rows.
    """
    x = np.asarray(x, dtype=float)
    step = np.where(x > 2 * GRID_OCTAVE, 2.0 ** (np.frexp(x)[1] - 6), np.where((x > 0) & (x < 1), 1 / GRID_SHARES, 1.0))
    return np.floor(x / step) * step


# Gradients are summed as whole multiples of 1 / UNIT: the sums do not depend on the order of rows.
UNIT = 2.0**24
RIDGE = 1.0
MIN_NODE = 8
Block = dict[str, np.ndarray]  # rows of training: bins, held, label, like, w; in boosting y, group, total


def add_node(tree: Tree, g: float, h: float) -> int:
    for part, v in ((tree.feature, -1), (tree.threshold, 0.0), (tree.left, -1), (tree.right, -1), (tree.value, -g / (h + RIDGE))):
        part.append(v)
    return len(tree.feature) - 1


def histograms(blocks: Iterator[Block], trees: list[Tree], slots: list[np.ndarray], columns: list[int], sizes: list[int]):
    """Sums of gradients and hessians by open node, feature and value, and the rows of each node."""
    n = 1 + max(int(s.max()) for s in slots)
    ends = np.cumsum(sizes)
    sums, rows_of = np.zeros((2, n, int(ends[-1]))), np.zeros(n)
    for block in blocks:
        p = 1.0 / (1.0 + np.exp(-block["total"]))
        g = np.rint((p - block["y"]) * UNIT) * block["w"]
        h = np.rint(p * (1 - p) * UNIT) * block["w"]
        for m, tree in enumerate(trees):
            rows = np.flatnonzero(block["group"] == m)
            slot = slots[m][tree.leaf(block["bins"][rows])]
            rows, slot = rows[slot >= 0], slot[slot >= 0]
            if not len(rows):
                continue
            rows_of += np.bincount(slot, block["w"][rows], n)
            for j in columns:
                at, own = slot * sizes[j] + block["bins"][rows, j], slice(ends[j] - sizes[j], ends[j])
                for k, part in enumerate((g, h)):
                    sums[k, :, own] += np.bincount(at, part[rows], n * sizes[j]).reshape(n, sizes[j])
    yield sums, rows_of


def added_up(parts: RDD):
    """Sum of one small result a partition; many are summed in steps, not all at the driver."""
    return parts.treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)), 2 if parts.getNumPartitions() > 16 else 1)


def grow_trees(blocks: RDD, values: list[np.ndarray], columns: list[int], n_trees: int, depth: int) -> list[Tree]:
    """One regression tree for each group of rows, split by gain; every level is one job over all rows.

    Only sums by node, feature and value come to the driver. Thresholds are in bins.
    """
    trees = [Tree() for _ in range(n_trees)]
    open_nodes = [(m, add_node(tree, 0.0, 0.0)) for m, tree in enumerate(trees)]
    sizes = [len(v) for v in values]
    ends = np.cumsum(sizes)
    for level in range(depth):
        slots = [np.full(len(tree.feature), -1) for tree in trees]
        for k, (m, at) in enumerate(open_nodes):
            slots[m][at] = k
        (sums_g, sums_h), rows_of = added_up(
            blocks.mapPartitions(partial(histograms, trees=trees, slots=slots, columns=columns, sizes=sizes))
        )
        sums_g, sums_h = sums_g / UNIT, sums_h / UNIT
        own = slice(ends[columns[0]] - sizes[columns[0]], ends[columns[0]])
        g, h = sums_g[:, own].sum(axis=1), sums_h[:, own].sum(axis=1)
        gain, best = np.full(len(open_nodes), 1e-6), [None] * len(open_nodes)
        for j in columns:
            if sizes[j] < 2:
                continue
            own = slice(ends[j] - sizes[j], ends[j])
            gl, hl = np.cumsum(sums_g[:, own], axis=1)[:, :-1], np.cumsum(sums_h[:, own], axis=1)[:, :-1]
            gr, hr = g[:, None] - gl, h[:, None] - hl
            gains = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - (g**2 / (h + RIDGE))[:, None]
            for k in np.flatnonzero((gains.max(axis=1) > gain) & (rows_of >= MIN_NODE)):
                cut = int(np.argmax(gains[k]))
                gain[k], best[k] = gains[k, cut], (j, cut, gl[k, cut], hl[k, cut])
        following = []
        for k, (m, at) in enumerate(open_nodes):
            tree = trees[m]
            if level == 0:
                tree.value[at] = -g[k] / (h[k] + RIDGE)
            if best[k] is None:
                continue
            j, cut, gl, hl = best[k]
            own = slice(ends[j] - sizes[j], ends[j])
            more = np.flatnonzero((sums_h[k, own] > 0) | (sums_g[k, own] != 0))
            above = int(more[more > cut][0]) if (more > cut).any() else cut + 1
            between = (values[j][cut] + values[j][above]) / 2
            tree.feature[at], tree.threshold[at] = j, float(np.searchsorted(values[j], between, "right")) - 0.5
            tree.left[at], tree.right[at] = add_node(tree, gl, hl), add_node(tree, g[k] - gl, h[k] - hl)
            following += [(m, tree.left[at]), (m, tree.right[at])]
        open_nodes = following
        if not open_nodes:
            break
    return trees


def in_values(tree: Tree, values: list[np.ndarray]) -> Tree:
    """The tree with thresholds on features in place of bins."""
    cut = lambda j, t: float(values[j][int(t)] + values[j][int(t) + 1]) / 2 if j >= 0 else 0.0
    return Tree(tree.feature, [cut(j, t) for j, t in zip(tree.feature, tree.threshold)], tree.left, tree.right, tree.value)


@dataclass
class PiiModel:
    """Boosted trees and the least score of each added kind (above 1: none is selected)."""

    trees: list[Tree]
    base: float
    thresholds: dict[int, float]
    rate: float = RATE

    def score(self, x: np.ndarray) -> np.ndarray:
        x = grid(x)
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total += self.rate * tree.predict(x)
        return 1.0 / (1.0 + np.exp(-total))


def total_of(trees: list[Tree], base: float, bins: np.ndarray, rate: float) -> np.ndarray:
    total = np.full(len(bins), base)
    for tree in trees:
        total += rate * tree.predict(bins)
    return total


def stepped(block: Block, trees: list[Tree], rate: float) -> Block:
    """The block with the trees' values added to the totals of their groups."""
    total = block["total"].copy()
    for m, tree in enumerate(trees):
        own = block["group"] == m
        total[own] += rate * tree.predict(block["bins"][own])
    return block | {"total": total}


def boost(
    blocks: RDD, values: list[np.ndarray], columns: list[int], n_models: int = 1, rounds: int = 40, depth: int = 4, rate: float = RATE
) -> tuple[list[list[Tree]], list[float]]:
    """Boosted trees in bins, and the base, for each group of rows; the models grow side by side."""

    def counted(some: Iterator[Block]):
        out = np.zeros((n_models, 2))
        for block in some:
            for m in range(n_models):
                own = block["group"] == m
                out[m] += [(block["w"] * block["y"])[own].sum(), block["w"][own].sum()]
        yield (out,)

    (counts,) = added_up(blocks.mapPartitions(counted))
    base = [float(np.log((hits + 1) / (n - hits + 1))) for hits, n in counts]
    start = np.array([*base, 0.0])  # rows of no group, -1, take the last
    now, before = blocks.map(lambda block: block | {"total": start[block["group"]]}).persist(STORED), None
    models: list[list[Tree]] = [[] for _ in base]
    for _ in range(rounds):
        trees = grow_trees(now, values, columns, n_models, depth)
        if before is not None:
            before.unpersist()
        for model, tree in zip(models, trees):
            model.append(tree)
        now, before = now.map(partial(stepped, trees=trees, rate=rate)).persist(STORED), now
    before.unpersist()
    now.unpersist()
    return models, base


STORED = StorageLevel.MEMORY_AND_DISK
# Totals are ranked in steps of 1 / RANKS: scores of all rows are counted in few cells.
RANKS = 100


def cells_of(total: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(total * RANKS), -MAX_CELL, MAX_CELL).astype(np.int64)


MAX_CELL = 4_000


def counted_cells(blocks: RDD, rows_of) -> np.ndarray:
    """Rows by part, kind and cell: ``rows_of`` gives row numbers, parts and totals of a block."""

    def counted(some: Iterator[Block]):
        out = np.zeros((2, len(KINDS), 2 * MAX_CELL + 1))
        for block in some:
            rows, part, total = rows_of(block)
            np.add.at(out, (part, block["kind"][rows], cells_of(total) + MAX_CELL), block["w"][rows])
        yield (out,)

    return added_up(blocks.mapPartitions(counted))[0]


def calibrated(counts: np.ndarray, precision: float) -> dict[int, float]:
    """Per kind, the least score from which on held-out candidates keep the precision."""
    out = {}
    for kind in range(len(BASE_KINDS), len(KINDS)):
        wrong, hit = (np.cumsum(counts[label, kind][::-1])[::-1] for label in (0, 1))
        some = counts[0, kind] + counts[1, kind] > 0
        good = np.flatnonzero(some & (hit >= precision * (hit + wrong)) & (hit >= 5))
        out[kind] = max(0.5, 1.0 / (1.0 + np.exp(-(good[0] - MAX_CELL) / RANKS))) if len(good) else 2.0
    return out


def apart(base: list[tuple[int, int, int]]):
    """Whether a span overlaps none of the given ones."""
    merged: list[list[int]] = []
    for start, _, end in sorted(base):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    starts, ends = [m[0] for m in merged], [m[1] for m in merged]

    def free(a: int, b: int) -> bool:
        k = bisect.bisect_right(ends, a)
        return k == len(starts) or b <= starts[k]

    return free


def training_rows(text: str, seed: int) -> list[list[float]]:
    """Feature rows of one text, the label first and the style last."""
    base = base_spans(text)
    rows = []
    free, fixed = apart(base), {(a, b) for a, _, b in base}
    for s, kind, e in candidates(text):
        if free(s, e):
            rows.append([verified(kind, text[s:e]), *span_features(text, s, kind, e), style_of(kind, text[s:e])])
        elif (s, e) in fixed:
            rows.append([1.0, *span_features(text, s, kind, e), style_of(kind, text[s:e])])
    rng = np.random.default_rng(seed % (2**32)) if base else None
    for s, kind, e in base:
        before, after = text[max(0, s - CONTEXT) : s], text[e : e + CONTEXT]
        for label, made in ((1.0, rewritten), (0.0, broken)):
            for to, body in made(kind, text[s:e], rng):
                at = len(before)
                rows.append([label, *span_features(before + body + after, at, to, at + len(body)), style_of(to, body)])
    return rows


CONTEXT_COLUMNS = range(24, 32)  # of span_features: what stands before and after
N_FEATURES = len(span_features("0", 0, 5, 1))
ROWS_AT_ONCE = 20_000


def training_cells(docs: DataFrame) -> DataFrame:
    """The training rows of all documents: equal ones once, with their number ``w``.

    ``x`` holds the features on the grid, ``like`` whether a positive is written in the same style.
    """

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: list[tuple[int, list[float]]] = []

        def frame() -> pd.DataFrame:
            data = np.array([row for _, row in made])
            return pd.DataFrame(
                {
                    "held": np.array([i % 3 == 0 for i, _ in made]),
                    "label": data[:, 0].astype(np.int32),
                    "style": data[:, -1].astype(np.int64),
                    "x": [x.tobytes() for x in grid(data[:, 1:-1]).astype(np.float32)],
                }
            )

        for batch in batches:
            for i, text in zip(batch["id"], batch["text"]):
                made += [(int(i), row) for row in training_rows(text, int(i))] if text else []
                if len(made) >= ROWS_AT_ONCE:
                    yield frame()
                    made.clear()
        if made:
            yield frame()

    texts = docs.select(F.xxhash64("doc_id").alias("id"), "text")
    rows = texts.mapInPandas(examples, "held boolean, label int, style long, x binary")
    cells = written(rows.groupBy("held", "label", "style", "x").agg(F.count(F.lit(1)).alias("w")))
    positive = cells.filter("label = 1").select(F.col("style").alias("__style"), F.lit(True).alias("__like")).distinct()
    like = F.coalesce("__like", F.lit(False)).alias("like")
    return cells.join(positive, F.col("style") == F.col("__style"), "left").select("held", "label", "x", "w", like)


def features_of(rows: list) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r["x"]) for r in rows), dtype=np.float32).reshape(len(rows), N_FEATURES)


def chunks(rows: Iterator) -> Iterator[list]:
    rows = iter(rows)
    while some := list(itertools.islice(rows, ROWS_AT_ONCE)):
        yield some


def training_values(cells: RDD) -> list[np.ndarray]:
    """All values of every feature: bounded by the grid."""

    def found(rows: Iterator) -> Iterator[list[set]]:
        out: list[set] = [set() for _ in range(N_FEATURES)]
        for some in chunks(rows):
            for mine, column in zip(out, features_of(some).T):
                mine.update(np.unique(column).tolist())
        yield out

    both = cells.mapPartitions(found).treeReduce(lambda a, b: [x | y for x, y in zip(a, b)])
    return [np.array(sorted(v)) for v in both]


def training_blocks(cells: RDD, values: list[np.ndarray]) -> RDD:
    """The training rows as arrays, features as numbers of their values."""

    def blocks(rows: Iterator) -> Iterator[Block]:
        for some in chunks(rows):
            x = features_of(some)
            yield {
                "bins": np.stack([np.searchsorted(v, x[:, j]) for j, v in enumerate(values)], axis=1).astype(np.uint16),
                "kind": x[:, 0].astype(np.int64),
                **{c: np.array([r[c] for r in some]) for c in ("held", "label", "like", "w")},
            }

    return cells.mapPartitions(blocks)


def reliable_negatives(blocks: RDD, values: list[np.ndarray]) -> RDD:
    """Blocks labelled 1 and 0 (``y``): unlabelled rows written like no positive that score below nearly all of
    their kind, by a model that saw neither, are 0 too. ``group`` is 0 for rows that train, 1 for held-out ones
    and -1 for those that do neither.

    The context is left out: rewritten spans stand in that of the fixed formats, other data need not.
    """
    columns = [j for j in range(N_FEATURES) if j not in CONTEXT_COLUMNS]
    halves = blocks.map(lambda b: b | {"group": b["held"].astype(np.int64), "y": (b["label"] == 1).astype(float)})
    models, base = boost(halves, values, columns, n_models=2)

    def unseen(block: Block) -> np.ndarray:
        total = np.zeros(len(block["w"]))
        for part in (0, 1):
            own = block["held"] == bool(part)
            total[own] = total_of(models[1 - part], base[1 - part], block["bins"][own], RATE)
        return total

    def spies(block: Block):
        rows = np.flatnonzero(block["label"] == 1)
        return rows, block["held"][rows].astype(np.int64), unseen(block)[rows]

    running = np.cumsum(counted_cells(blocks, spies), axis=2)
    number = running[:, :, -1:]
    least = np.argmax(running > SPY_SHARE * (number - 1), axis=2) - MAX_CELL
    least[number[:, :, 0] < 5] = -MAX_CELL

    def labelled(block: Block) -> Block:
        cell = cells_of(unseen(block))
        below = (block["label"] == UNLABELLED) & ~block["like"] & (cell < least[block["held"].astype(np.int64), block["kind"]])
        label = np.where(below, 0.0, block["label"])
        return block | {"y": np.maximum(label, 0.0), "group": np.where(label == UNLABELLED, -1, block["held"].astype(np.int64))}

    return blocks.map(labelled)


def fit_model(docs: DataFrame) -> PiiModel:
    """Train and calibrate on the candidates of all documents.

    Rows of training stay with the executors; sums, counts and values come to the driver.
    """
    cells = training_cells(docs)
    whole = cells.agg(
        F.sum(F.when(F.col("label") == 1, F.col("w"))), F.sum("w"), F.sum(F.when(F.col("held"), F.col("w")))
    ).first()
    positives, rows, held = (int(v or 0) for v in whole)
    if positives < 5 or positives == rows:
        return PiiModel([], -20.0, {})
    values = training_values(cells.rdd)
    blocks = training_blocks(cells.rdd, values).persist(STORED)
    if 0 < held < rows:
        known = reliable_negatives(blocks, values).persist(STORED)
    else:  # nothing to compare with: unlabelled rows neither train nor calibrate
        known = blocks.map(
            lambda b: b | {"y": np.maximum(b["label"], 0.0), "group": np.where(b["label"] == UNLABELLED, -1, b["held"].astype(np.int64))}
        ).persist(STORED)
    trees, base = boost(
        known.map(lambda b: b | {"group": np.where(b["group"] == 0, 0, -1)}), values, list(range(N_FEATURES))
    )

    def judged(block: Block):
        out = np.flatnonzero(block["group"] == 1)
        return out, block["y"][out].astype(np.int64), total_of(trees[0], base[0], block["bins"][out], RATE)

    thresholds = calibrated(counted_cells(known, judged), MIN_PRECISION)
    known.unpersist()
    blocks.unpersist()
    return PiiModel([in_values(t, values) for t in trees[0]], base[0], thresholds, RATE)


def added_spans(text: str, base: list[tuple[int, int, int]], model: PiiModel) -> list[tuple[int, int, int]]:
    """Selected candidates outside the base spans; of overlapping ones the best score, then the first."""
    clear = apart(base)
    free = [c for c in candidates(text) if clear(c[0], c[2])]
    if not free:
        return []
    scores = model.score(np.array([span_features(text, *c) for c in free], dtype=float))
    chosen: list[tuple[int, int, int]] = []
    for score, c in sorted(zip(scores, free), key=lambda z: (-z[0], z[1])):
        if score >= model.thresholds.get(c[1], 2.0) and all(c[2] <= s or e <= c[0] for s, _, e in chosen):
            chosen.append(c)
    return sorted(chosen)


SPANS = "base array<struct<start:int,kind:int,end:int>>, added array<struct<start:int,kind:int,end:int>>"


def spans_of(model: PiiModel):
    """A Pandas UDF: text -> struct of the base spans and the added ones."""

    def spans(texts: pd.Series) -> pd.DataFrame:
        base, added = [], []
        for text in texts:
            own = base_spans(text) if text else []
            more = added_spans(text, own, model) if text else []
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
            added.append([{"start": s, "kind": k, "end": e} for s, k, e in more])
        return pd.DataFrame({"base": base, "added": added})

    spans.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(spans, SPANS)


def redactor(model: PiiModel):
    """A Pandas UDF: text -> the text with every span replaced by [KIND]; overlapping spans merge."""

    def redacted(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            if not text:
                out.append(text)
                continue
            own = base_spans(text)
            pieces, at = [], 0
            for start, kind, end in sorted(own + added_spans(text, own, model)):
                if start >= at:
                    pieces += [text[at:start], f"[{KINDS[kind].upper()}]"]
                at = max(at, end)
            out.append("".join(pieces) + text[at:])
        return pd.Series(out, dtype=object)

    redacted.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(redacted, "string")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; n_chars follows the new text where it exists."""
    small_batches(docs.sparkSession)
    model = fit_model(docs)
    out = docs.withColumn("text", redactor(model)(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the fixed formats and all spans of every document."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", spans_of(fit_model(docs))(F.col("text")).alias("s")).select("doc_id", "s.*")
    names = F.array(*[F.lit(k) for k in KINDS])
    digest = lambda spans: F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)],
        F.sha2(digest(F.col("base")), 256).alias("base_sha256"),
        digest(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
