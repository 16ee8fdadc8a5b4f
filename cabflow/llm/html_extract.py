"""Main text of web pages with wrappers inferred per host.

A page is read as a tree of block elements with text between them. The trees of one
host are aligned one after the other into a wrapper, a union-free regular
expression over tokens: equal neighbours fold into a repeated group, a token that
only one side has becomes optional, a text that differs becomes a slot, which keeps
a hash of its most frequent text with that text's votes. Wrappers
merge like pages do, so each task aligns its own pages of a host, then groups of
those wrappers are merged, then the groups: no task sees all pages of a host.

The wrapper says which texts are the template's (the same on nearly all pages) and
which element holds the varying text: an article, main or named element where the
wrapper finds at least half of the varying text in it, otherwise the element down to
which most of it leads. Where the wrapper does not decide (fewer than five pages, or
nothing narrower than the body), the tags do. A page's
main text is what stands in that element outside menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments. Names of
classes and ids that are also ordinary words (discussion, related, search) remove an
element only where its host's wrapper shows it constant or mostly links.

Defined results: null or empty html gives an empty text; white space of any kind
inside a block becomes one space; a line break tag is white space; blocks are
joined by one newline, empty ones left out; markup cut off at the end of a page is
no text; pages without a host are extracted without a wrapper; repeated rows are
extracted each time; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import load, materialized

# Wrappers are shipped to every task up to this size in all, and joined by host beyond it.
BROADCAST_BYTES = 16_000_000
SALTS = 64
MAX_KIDS = 64
# Elements below this depth stand side by side at it (browsers do the same, at 512), so that
# no walk over a tree goes deeper; their texts keep their order and blocks.
MAX_DEPTH = 250
# Lists of elements are aligned by a table up to this many cells, by their labels' turns beyond it.
TABLE_CELLS = 250_000
# Pages that must agree before a text counts as the template's.
TEMPLATE_PAGES = 5
# Votes (pages with the text less those with another) over pages from which a text is the template's:
# one on 90 % of a host's pages always is, one on fewer than 80 % never.
TEMPLATE_VOTES = 0.8
# Share of a host's varying text that an element named as the main one has to hold to be taken at its word.
HELD = 0.5
# Share of the characters inside links from which a doubtful element is a list of links.
MOSTLY_LINKS = 0.5

RAW = ("script", "style", "noscript", "textarea", "template", "iframe", "svg", "title", "select")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search"
    " section summary table tbody td tfoot th thead tr caption ul option optgroup".split()
)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# An opening tag ends these open ones (up to the nearest element that bounds them).
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}

# What a paragraph may be inside of: a block in one of these does not end it.
HOLDERS = frozenset(("table", "td", "th", "li", "div"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\b[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[A-Za-z][^>]*+\Z",
    re.S | re.I,
)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)

SKIPPED_TAGS = frozenset("head nav footer aside form fieldset button menu search dialog legend option optgroup".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Parts of class and id names that may mark what is not the article.
SKIPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted"
    " cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup"
    " sidebar side sidenav aside menu menus nav navbar navigation breadcrumb breadcrumbs crumbs footer foot masthead topbar"
    " comment comments commentlist discussion disqus reply replies respond response responses share sharing social related"
    " recommended recommendations widget widgets toolbar pagination pager login search skip skiplink copyright disclaimer"
    " hidden".split()
)
# Ordinary words of them: such a name alone, or beside a word that is not listed, says nothing certain.
ORDINARY_NAMES = frozenset(
    "side aside related search discussion reply replies respond response responses share sharing social notice notices"
    " alert alerts consent login skip copyright disclaimer promotion promoted recommended recommendations overlay widget"
    " widgets signup subscribe subscription menu menus navigation foot sponsor sponsored advertising comment".split()
)
# Parts that name a box of the page when they stand beside a listed one.
BOX_NAMES = frozenset("list box slot bar container wrapper wrap block links buttons button form icons unit panel thread".split())
# Ids are often made from headings: alone only names that are no headings, in compounds one part of these.
CLEAR_IDS = frozenset(
    "comments commentlist disqus sidebar sidenav navbar breadcrumb breadcrumbs masthead topbar adsense adslot pagination"
    " pager skiplink".split()
)
CLEAR_ID_PARTS = CLEAR_IDS | frozenset("ad ads cookie cookies gdpr comment newsletter nav".split())
MAIN_NAMES = frozenset("content article post entry story main body text".split())


def label_of(tag: str, attrs: str) -> str:
    """tag, then .names of class and #names of id without digits, @role and ! if hidden."""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return tag
    names, role, hidden = [], "", ""
    for m in ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "itemprop"):
            mark = "#" if key == "id" else "."
            names += [mark + n.strip("-_") for n in re.split(r"[\s0-9]+", value.lower()) if n.strip("-_")]
        elif key == "role":
            role = "@" + value.strip().lower()
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = "!"
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = "!"
    return tag + "".join(dict.fromkeys(names)) + role + hidden


def parts_of(name: str) -> list[str]:
    return [p for p in re.split(r"[-_:]+", name) if p]


def name_parts(label: str) -> list[str]:
    return [p for name in re.split(r"[.@!#]", label)[1:] for p in parts_of(name)]


def tag_of(label: str) -> str:
    return re.split(r"[.@!#]", label, maxsplit=1)[0]


def is_clear(mark: str, name: str) -> bool:
    """Whether a class (.) or id (#) name can only mean a part of the page that is not the article."""
    parts = parts_of(name)
    if len(parts) == 1:
        return parts[0] in CLEAR_IDS if mark == "#" else parts[0] in SKIPPED_NAMES - ORDINARY_NAMES
    if not set(parts) <= SKIPPED_NAMES | BOX_NAMES:
        return False
    return not set(parts).isdisjoint(CLEAR_ID_PARTS if mark == "#" else SKIPPED_NAMES)


@lru_cache(maxsize=100_000)
def kind_of(label: str, inside_article: bool) -> str:
    """"skipped": never part of the main text; "doubtful": its names may say so; else empty."""
    tag = tag_of(label)
    if label.endswith("!") or tag in SKIPPED_TAGS:
        return "skipped"
    if tag == "header" and not inside_article:
        return "skipped"
    role = re.search(r"@([a-z]+)", label)
    if role and role[1] in SKIPPED_ROLES:
        return "skipped"
    if tag in ("html", "body", "article", "main") or tag in HEADINGS:
        # Names of these describe the page or its type; reader comments are often articles.
        return "skipped" if tag in ("article", "main") and {"comment", "reply"} & set(name_parts(label)) else ""
    names = re.findall(r"([.#])([^.@!#]+)", label)
    if any(is_clear(mark, name) or mark == "." and name == "header" and not inside_article for mark, name in names):
        return "skipped"
    parts = {p for _, name in names for p in parts_of(name)}
    return "doubtful" if parts & SKIPPED_NAMES or "header" in parts and not inside_article else ""


def is_skipped(label: str, inside_article: bool) -> bool:
    """Whether an element is never part of the main text."""
    return kind_of(label, inside_article) == "skipped"


def page_tree(source: str | None) -> list:
    """[label, kids]; a text is ["#", text, characters inside links]."""
    root: list = ["", []]
    stack, tags = [root], [""]
    open_tags: Counter[str] = Counter()
    pieces: list[str] = []
    state = {"link": 0, "linked": 0}

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                if len(stack) > MAX_DEPTH:  # the node that is open stands last among those at the greatest depth
                    shelf = stack[MAX_DEPTH - 1][1]
                    if not shelf or shelf[-1] is not stack[-1]:
                        stack[-1] = [stack[-1][0], []]
                        shelf.append(stack[-1])
                stack[-1][1].append(["#", text, min(state["linked"], len(text))])
            pieces.clear()
        state["linked"] = 0

    def put(raw: str) -> None:
        if raw:
            if "&" in raw:
                raw = entities.unescape(raw)
            pieces.append(raw)
            if state["link"]:
                state["linked"] += len(raw)

    def close_to(k: int) -> None:
        flush()
        open_tags.subtract(tags[k:])
        del stack[k:], tags[k:]

    def last(tag: str) -> int:
        """Where the innermost open element of a tag stands; what lies above it is about to be closed."""
        k = len(tags) - 1
        while tags[k] != tag:
            k -= 1
        return k

    at = 0
    for m in TOKEN.finditer(source or ""):
        put(source[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, closing = tag.lower(), bool(m["close"] or m["close2"])
        if tag == "br":
            pieces.append(" ")
        elif tag not in BLOCKS:
            if tag == "a":
                state["link"] = 0 if closing else 1
            elif "-" in tag and not closing:  # a custom element may hold blocks: only a boundary
                flush()
        elif closing:
            flush()
            if open_tags[tag]:
                close_to(last(tag))
            state["link"] = 0
        else:
            flush()
            if open_tags["p"]:  # a block ends an open paragraph
                k = len(tags) - 1
                while tags[k] != "p" and tags[k] not in HOLDERS:
                    k -= 1
                if tags[k] == "p":
                    close_to(k)
            ends, bounds = ENDS.get(tag, ((), ()))
            k = len(tags) - 1
            while k > 0 and any(open_tags[e] for e in ends) and tags[k] not in bounds:
                if tags[k] in ends:
                    close_to(k)
                k -= 1
            state["link"] = 0
            if tag in VOID:
                continue
            node = [label_of(tag, m["attrs"] or m["attrs2"] or ""), []]
            if len(stack) < MAX_DEPTH:
                stack[-1][1].append(node)
            elif len(stack) > MAX_DEPTH and is_skipped(stack[-1][0], open_tags["article"] > 0):
                node[0] = stack[-1][0]
            stack.append(node)
            tags.append(tag)
            open_tags[tag] += 1
    put((source or "")[at:])
    flush()
    return root


# --- wrappers -----------------------------------------------------------------
# [label, pages, repeated, optional, kids]
# or ["#", pages, repeated, optional, text or None, characters, linked, key of the most frequent text, its votes]


def key_of(text: str) -> str:
    """Names a whole text of any length."""
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=9).hexdigest()


def wrapper_of(node: list) -> list:
    """The wrapper of a single page (sub)tree."""
    if node[0] == "#":
        key = key_of(node[1])
        return ["#", 1, False, False, node[1] if len(node[1]) <= 18 else key, len(node[1]), node[2], key, 1]
    return [node[0], 1, False, False, folded([wrapper_of(k) for k in node[1]])]


def folded(kids: list) -> list:
    """Runs of equal neighbours, of up to three tokens, become repeated groups."""
    for size in (1, 2, 3):
        out: list = []
        k = 0
        while k < len(kids):
            unit = kids[k : k + size]
            names = [u[0] for u in unit]
            to = k + size
            if len(set(names)) == size or size == 1:
                while len(unit) == size and [u[0] for u in kids[to : to + size]] == names:
                    unit = [merged(a, b, False) for a, b in zip(unit, kids[to : to + size])]
                    to += size
            if to > k + size:
                for u in unit:
                    u[2] = True
                out += unit
                k = to
            else:
                out.append(kids[k])
                k += 1
        kids = out
    return kids


def merged(a: list, b: list, pages: bool = True) -> list:
    """Both aligned: unequal texts become a slot, one-sided tokens optional."""
    n = a[1] + b[1] if pages else max(a[1], b[1])
    head = [a[0], n, a[2] or b[2], a[3] or b[3]]
    if a[0] == "#":
        text = a[4] if a[4] == b[4] else None
        if a[7] == b[7]:
            key, votes = a[7], a[8] + b[8] if pages else max(a[8], b[8])
        else:  # majority vote: a text's votes never exceed the pages that have it
            key, votes = (a[7], a[8] - b[8]) if a[8] >= b[8] else (b[7], b[8] - a[8])
        return [*head, text, a[5] + b[5], a[6] + b[6], key, votes]
    return [*head, aligned(a[4], b[4], pages)]


def turns_in_common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The longest common subsequence that matches each label's n-th turn in one with its
    n-th in the other, in time n log n."""
    turns: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        turns.setdefault(b[j], []).append(j)
    pairs = [(i, turns[x].pop()) for i, x in enumerate(a) if turns.get(x)]
    tails: list[int] = []  # least last place of an increasing run of each length, and its pair
    ends: list[int] = []
    before: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        tails[at : at + 1] = [j]
        ends[at : at + 1] = [k]
        before.append(ends[at - 1] if at else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def steps_of(a: list[str], b: list[str]) -> Iterator[tuple[int | None, int | None]]:
    """Both lists walked together: (i, j) where labels are matched, else one of them None."""
    if len(a) * len(b) > TABLE_CELLS:
        i = j = 0
        for to_i, to_j in [*turns_in_common(a, b), (len(a), len(b))]:
            yield from ((k, None) for k in range(i, to_i))
            yield from ((None, k) for k in range(j, to_j))
            if to_i < len(a):
                yield to_i, to_j
            i, j = to_i + 1, to_j + 1
        return
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            yield i, j
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            yield i, None
            i += 1
        else:
            yield None, j
            j += 1


def aligned(a: list, b: list, pages: bool) -> list:
    """Longest common subsequence of the labels; the rest is kept as optional."""
    names = [x[0] for x in a], [x[0] for x in b]
    if names[0] == names[1]:
        return [merged(x, y, pages) for x, y in zip(a, b)]
    out: list = []
    for i, j in steps_of(*names):
        if i is not None and j is not None:
            out.append(merged(a[i], b[j], pages))
        else:
            x = a[i] if i is not None else b[j]
            out.append([*x[:3], True, *x[4:]])
    out = folded(out)
    if len(out) > MAX_KIDS:  # one optional repeated group per label: the wrapper stays bounded
        by_label: dict[str, list] = {}
        for x in out:
            by_label[x[0]] = merged(by_label[x[0]], x, False) if x[0] in by_label else x
        out = [[x[0], x[1], True, True, *x[4:]] for x in by_label.values()]
    return out


def kinds_at(label: str) -> set[str]:
    """What the names of an element claim it to be: article, main or a named container."""
    tag = tag_of(label)
    kinds = {tag} & {"article", "main"}
    if "@main" in label or re.search(r"[.#]articlebody\b", label):
        kinds.add("main")
    if tag in ("div", "section", "td") and MAIN_NAMES & set(name_parts(label)):
        kinds.add("named")
    return kinds


def wrapper_facts(wrapper: list) -> dict:
    """What extraction needs: texts of the template and lists of links by path, the main element, the order to look in."""
    pages = wrapper[1]
    fixed: dict[str, set[str]] = {}
    linked: dict[str, list[int]] = {}  # characters, and those in links, of the doubtful elements by path
    held = {"article": 0.0, "main": 0.0, "named": 0.0}

    def size_of(node: list) -> tuple[int, int]:
        if node[0] == "#":
            return node[5], node[6]
        sizes = [size_of(k) for k in node[4]]
        return sum(n for n, _ in sizes), sum(n for _, n in sizes)

    def walk(node: list, path: str, where: frozenset[str]) -> None:
        if node[0] == "#":
            if is_template(node, pages):
                fixed.setdefault(path, set()).add(node[7])
            for kind in where:
                held[kind] += weight_of(node, pages, where)
            return
        inside = f"{path}/{node[0]}" if node[0] else path
        kind = kind_of(node[0], "article" in where) if node[0] else ""
        if kind == "skipped":
            return
        if kind == "doubtful":
            chars, links = size_of(node)
            had = linked.setdefault(inside, [0, 0])
            had[0], had[1] = had[0] + chars, had[1] + links
        where = where | kinds_at(node[0])
        for k in node[4]:
            walk(k, inside, where)

    walk(wrapper, "", frozenset())
    total = weight_of(wrapper, pages)
    main, node = "", wrapper
    while total > 0:
        kids = [(weight_of(k, pages), k) for k in node[4] if k[0] != "#"]
        weight, kid = max(kids, key=lambda z: z[0], default=(0.0, None))
        if kid is None or weight <= 0 or weight < 0.7 * sum(weight_of(k, pages) for k in node[4]):
            break
        if kid[2] or tag_of(kid[0]) in ("p", "li", "tr", *HEADINGS):
            break
        main, node = f"{main}/{kid[0]}", kid
    links = {path for path, (chars, inner) in linked.items() if inner >= MOSTLY_LINKS * max(1, chars)}
    named = list(held)
    trusted = [k for k in named if total > 0 and held[k] >= HELD * total]
    if pages < TEMPLATE_PAGES or tag_of(node[0]) in ("", "html", "body"):  # the wrapper does not decide
        order = [*named, "region", "rest"]
    else:
        order = [*trusted, "region", *[k for k in named if k not in trusted], "rest"]
    return {"pages": pages, "fixed": fixed, "links": links, "main": main, "trusted": trusted, "order": order}


def is_template(node: list, pages: int) -> bool:
    return node[8] >= max(TEMPLATE_PAGES, TEMPLATE_VOTES * pages)


def weight_of(node: list, pages: int, where: frozenset[str] = frozenset()) -> float:
    """Weight of the varying text below, links and what is never main text left out."""
    if node[0] == "#":
        share = 1.0 - node[8] / node[1] if is_template(node, pages) else 1.0
        return share * max(0.0, node[5] - 2.0 * node[6])
    if node[0] and is_skipped(node[0], "article" in where):
        return 0.0
    where = where | kinds_at(node[0])
    return sum(weight_of(k, pages, where) for k in node[4])


def main_text(source: str | None, facts: dict | None) -> str:
    """The main text of one page, with the facts of its host's wrapper if there is one."""
    if not source:
        return ""
    tree = page_tree(source)
    if facts is None:
        facts = wrapper_facts(wrapper_of(tree))
    # (text, whether it is the template's, whether it is left out then)
    found: dict[str, list[tuple[str, bool, bool]]] = {k: [] for k in facts["order"]}
    fixed, links, region = facts["fixed"], facts["links"], facts["main"]

    def is_fixed(text: str, inside: str) -> bool:
        return inside in fixed and key_of(text) in fixed[inside]

    def all_fixed(node: list, inside: str) -> bool:
        return all(is_fixed(k[1], inside) if k[0] == "#" else all_fixed(k, f"{inside}/{k[0]}") for k in node[1])

    def walk(node: list, path: str, where: frozenset[str], boxed: bool) -> None:
        label = node[0]
        inside = f"{path}/{label}" if label else path
        kind = kind_of(label, "article" in where) if label else ""
        if kind == "skipped" or kind == "doubtful" and inside in links:
            return
        boxed = boxed or kind == "doubtful" and all_fixed(node, inside)
        where = where | kinds_at(label)
        if region and inside == region:
            where = where | {"region"}
        for kid in node[1]:
            if kid[0] != "#":
                walk(kid, inside, where, boxed)
                continue
            same = is_fixed(kid[1], inside)
            one = (kid[1], same, same and (boxed or tag_of(label) not in HEADINGS))
            found["rest"].append(one)
            for kind in where:
                found[kind].append(one)

    walk(tree, "", frozenset(), False)
    for kind in facts["order"]:
        if not all(same for _, same, _ in found[kind]):
            return "\n".join(text for text, _, out in found[kind] if not out)
        if found[kind] and kind in facts["trusted"]:
            break
    # The page repeats what most pages of its host are: a copy, not a template without a text.
    kind = next((k for k in facts["order"] if found[k]), "rest")
    return "\n".join(text for text, _, _ in found[kind])


# --- over all pages -----------------------------------------------------------


def with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return pages.select("page_id", "url", "html", F.lower(host).alias("host"))


def _page_wrappers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Wrappers of the pages of each host in a task, aligned batch by batch."""
    for batch in batches:
        own: dict[str, list] = {}
        for host, source in zip(batch["host"], batch["html"]):
            if host and source:
                one = wrapper_of(page_tree(source))
                own[host] = merged(own[host], one) if host in own else one
        if own:
            yield pd.DataFrame({"host": list(own), "wrapper": [json.dumps(w) for w in own.values()]})


def _merge_group(group: pd.DataFrame) -> pd.DataFrame:
    wrapper = None
    for text in sorted(group["wrapper"]):
        one = json.loads(text)
        wrapper = one if wrapper is None else merged(wrapper, one)
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(wrapper)]})


def host_wrappers(pages: DataFrame) -> DataFrame:
    """host and wrapper (JSON), one row per host of ``pages`` (with host and html)."""
    schema = "host string, wrapper string"
    parts = pages.select("host", "html").mapInPandas(_page_wrappers, schema)
    parts = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    parts = parts.groupBy("host", "salt").applyInPandas(_merge_group, schema)
    return parts.groupBy("host").applyInPandas(_merge_group, schema)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = with_host(pages)
    wrappers = materialized(host_wrappers(rows))
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        known = {r["host"]: wrapper_facts(json.loads(r["wrapper"])) for r in wrappers.collect()}

        def texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for hosts, sources in batches:
                yield pd.Series([main_text(s, known.get(h)) for h, s in zip(hosts, sources)], dtype=object)

        texts.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
        text = F.pandas_udf(texts, "string")(F.col("host"), F.col("html"))
    else:
        rows = rows.join(wrappers, "host", "left")

        def texts_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for found, sources in batches:
                facts = {w: wrapper_facts(json.loads(w)) for w in found.unique() if isinstance(w, str)}
                yield pd.Series([main_text(s, facts.get(w)) for w, s in zip(found, sources)], dtype=object)

        texts_of.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
        text = F.pandas_udf(texts_of, "string")(F.col("wrapper"), F.col("html"))
    out = rows.select("page_id", "url", text.alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(load(spark, sf_dir, "pages"))
