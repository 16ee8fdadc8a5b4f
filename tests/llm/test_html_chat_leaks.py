import re

from cabflow.llm import chat_format as c
from cabflow.llm import decontaminate as d
from cabflow.llm import html_extract as h
from cabflow.llm.common import load
from tests.llm.edge_tables import documents, prose, write


def page(i, body, extra=""):
    return (
        f'<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var a="<p>x</p>";</script></head><body>'
        f'<header class="top">Site name</header><nav><ul><li><a href="/{i}">Menu {i}</a></li></ul></nav>'
        f'<div class="cookie-notice">We use cookies</div><div class="ad">Buy {i}</div>{body}'
        f'<aside>Side {i}</aside><form><label>Mail</label></form>{extra}<footer>&copy; {i}</footer></body></html>'
    )


def test_article_and_region_pages(spark, tmp_path):
    rows, want = [], {}
    for i in range(12):
        body = f"<article><h1>Head {i} &amp; more</h1><p>First   para {i}<br>goes\n on<p>Second &lt;{i}&gt; <b>bold</b><ul><li>one {i}<li>two</ul></article>"
        rows.append((i, f"https://a.example.org/{i}", page(i, body, f'<section id="comments"><p>Nice {i}</p></section>')))
        want[i] = f"Head {i} & more\nFirst para {i} goes on\nSecond <{i}> bold\none {i}\ntwo"
        body = f'<div id="wrap"><p>Share this page</p><p>Text {i} {prose(30, i)}</p><table><tr><td>cell {i}<td>x</table></div>'
        rows.append((100 + i, f"https://b.example.org/{i}?q", page(i, body)))
        want[100 + i] = f"Text {i} {prose(30, i)}\ncell {i}\nx"
    rows += [(200, "u", None), (201, None, ""), (202, "https://c.org/", "<p>cut off &am"), (203, "https://c.org/", "a < b <p>c</p <!-- x"), (203, None, "<p>ümlaut &#233;&nbsp;x")]
    sf = write(spark, tmp_path, documents(spark, []), pages=[(*r, "x", "y") for r in rows])
    out = h.op6_html_extract(spark, sf).collect()
    assert len(out) == len(rows)
    got = {r["page_id"]: r["text"] for r in out}
    for i in range(12):
        assert got[i] == want[i]
        assert got[100 + i].endswith(want[100 + i])
    assert got[200] == "" and got[201] == "" and got[202] == "cut off &am"
    assert "ümlaut é x" in {r["text"] for r in out}
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    joined = h.extract.__globals__
    before = joined["BROADCAST_BYTES"]
    try:  # wrappers joined by host give the same texts
        joined["BROADCAST_BYTES"] = 0
        again = h.op6_html_extract(spark, sf).collect()
    finally:
        joined["BROADCAST_BYTES"] = before
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_sections_named_by_ordinary_words_stay():
    ids = ("side-effects", "related-work", "discussion", "search-strategy", "hidden-layers", "response-rates", "social", "advertising")
    sources, want = [], []
    for i in range(8):
        body = "".join(f'<section id="{n}"><h2>{n}</h2><p>{n} text {i} {prose(9, i)}</p></section>' for n in ids)
        boxes = '<div class="related"><p>Read our magazine</p></div><div class="cookie-notice">ok %d</div>' % i
        boxes += f'<ul class="share-links"><li>{i}</ul><div class="social-feed"><p><a href="/{i}">Other story {i}</a></p></div>'
        boxes += f'<section id="comments"><p>Nice {i}</p></section><div class="ad">Buy {i}</div>'
        sources.append(page(i, f"<article><h1>Head {i}</h1>{body}{boxes}</article>"))
        want.append("\n".join([f"Head {i}", *[x for n in ids for x in (n, f"{n} text {i} {prose(9, i)}")]]))
    wrapper = None
    for source in sources:
        one = h.wrapper_of(h.page_tree(source))
        wrapper = one if wrapper is None else h.merged(wrapper, one)
    facts = h.wrapper_facts(wrapper)
    assert [h.main_text(s, facts) for s in sources] == want
    alone = h.main_text(sources[0], None)  # without a wrapper nothing shows that the magazine's line is constant
    assert alone == want[0] + "\nRead our magazine"


def facts_of(sources):
    wrapper = None
    for source in sources:
        one = h.wrapper_of(h.page_tree(source))
        wrapper = one if wrapper is None else h.merged(wrapper, one)
    return h.wrapper_facts(wrapper)


def test_wrapper_chooses_the_region_before_tags():
    teaser = "<article><h3>Other</h3><p>Read our magazine</p></article>"
    sources = [page(i, f'<div id="wrap"><h1>Head {i}</h1><p>{prose(60, i)}</p></div>{teaser}') for i in range(8)]
    facts = facts_of(sources)
    assert [h.main_text(s, facts) for s in sources] == [f"Head {i}\n{prose(60, i)}" for i in range(8)]


def test_template_texts_of_any_length_on_nearly_all_pages():
    consent = "We use your data. " + prose(80)
    assert len(consent) > 200
    sources = [page(i, f"<article><h1>Head {i}</h1><p>{prose(40, i)}</p><div>{consent}</div></article>") for i in range(20)]
    other = page(99, f"<article><h1>Head</h1><p>{prose(40, 99)}</p><div>Something else</div></article>")
    facts = facts_of([*sources[:9], other, *sources[9:], "<table><tr><td>another layout</table>"])
    assert [h.main_text(s, facts) for s in sources] == [f"Head {i}\n{prose(40, i)}" for i in range(20)]
    assert h.main_text(other, facts) == f"Head\n{prose(40, 99)}\nSomething else"


def test_copies_of_a_page_keep_their_text():
    same = page(1, f"<article><h1>Head</h1><p>{prose(40, 1)}</p></article>")
    other = page(2, f"<article><h1>Another</h1><p>{prose(40, 2)}</p></article>")
    facts = facts_of([same] * 30 + [other])
    assert h.main_text(same, facts) == f"Head\n{prose(40, 1)}"
    assert h.main_text(other, facts) == f"Another\n{prose(40, 2)}"


def test_wrapper_groups():
    a = h.wrapper_of(h.page_tree("<div><h2>a</h2><p>x</p><h2>b</h2><p>y</p></div><div class=n1>same</div>"))
    b = h.wrapper_of(h.page_tree("<div><h2>c</h2><p>z</p></div><div class=n2>same</div><hr><p>new</p>"))
    w = h.merged(a, b)
    top = {k[0]: k for k in w[4]}
    assert [k[0] for k in top["div"][4]] == ["h2", "p"] and all(k[2] for k in top["div"][4])
    assert top["div"][4][0][4][0][4] is None  # a slot
    assert top["div.n"][4][0][4] == "same" and top["div.n"][1] == 2
    assert top["p"][3]  # optional


def test_articles_of_the_tables(spark):
    import html

    def truth(source):
        part = source[source.index("<article>") + 9 :].split("</article>")[0]
        part = re.sub(r"<[^>]*>|<[^>]*$", "", re.sub("<br>", " ", re.sub("</?(p|h1)>", "\0", part)))
        return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in part.split("\0")) if x)

    sf = "/root/testdata/sf0.01"
    want = {r["page_id"]: truth(r["html"]) for r in load(spark, sf, "pages").collect()}
    assert {r["page_id"]: r["text"] for r in h.op6_html_extract(spark, sf).collect()} == want


def test_chat_against_brute_force(spark, tmp_path):
    convs = {}
    for i in range(30):
        base = [("user" if k % 2 == 0 else "assistant", f"turn {k} of {i // 5} <|im_end|>") for k in range(6)]
        convs[i] = base[: 1 + i % 5 + (i % 7 == 0)]
    convs[40] = convs[4]
    convs[41] = [(None, None), ("user", "")]
    convs[42] = [("user", f"t{k}") for k in range(1200)]  # longer than a part
    rows = [(i, k, r, t, "x", "y") for i, v in convs.items() for k, (r, t) in enumerate(v)]
    rows += [(None, 0, "user", "lost", "x", "y"), (43, 0, "user", "twice", "x", "y"), (43, 0, "user", "twice", "x", "y"), (44, 0, "user", "twice", "x", "y"), (45, None, "user", "no turn", "x", "y")]
    sf = write(spark, tmp_path, documents(spark, []), conversations=rows)
    convs[None], convs[43], convs[44], convs[45] = [("user", "lost")], [("user", "twice")] * 2, [("user", "twice")], [("user", "no turn")]
    plain = {i: [(r or "", t or "") for r, t in v] for i, v in convs.items()}
    kept = {
        i for i, v in plain.items()
        if not any(len(w) > len(v) and w[: len(v)] == v for w in plain.values())
        and not any(w == v and j is not None and (i is None or j < i) for j, w in plain.items())
    }
    out = c.op9_chat_format(spark, sf).collect()
    assert {r["conv_id"] for r in out} == kept
    for r in out:
        turns = plain[r["conv_id"]][r["part"] * c.PART_TURNS : (r["part"] + 1) * c.PART_TURNS]
        assert r["n_turns"] == len(plain[r["conv_id"]])
        assert r["text"] == "".join(f"<|im_start|>{a}\n{b.replace('<|', '< |')}<|im_end|>\n" for a, b in turns)
    empty = write(spark, tmp_path / "none", documents(spark, []))
    assert c.op9_chat_format(spark, empty).count() == 0


def test_leaks_against_brute_force(spark, tmp_path):
    items = [(k, prose(30 + k, 300 + k)) for k in range(8)] + [(20, "short item"), (21, None), (22, "")]
    rows = [(i, prose(200, i), "a") for i in range(20)]
    for i in range(8):
        words = items[i][1].split()
        rows.append((100 + i, f"{prose(30, i)} {items[i][1].upper()}, {prose(20, i)}", "a"))
        words[len(words) // 2] = "changed"
        rows.append((200 + i, f"{prose(30, i)} {' '.join(words)} {prose(20, i)}", "a"))
        rows.append((300 + i, f"{prose(30, i)} {' '.join(items[i][1].split()[:12])} {prose(20, i)}", "a"))
        rows.append((400 + i, items[i][1], "a"))
    rows += [(500, "a Short, item.", "b"), (501, None, "b"), (502, "", "b"), (503, "short", "b")]
    sf = write(spark, tmp_path, documents(spark, rows), benchmark=items)
    found = d.op10_decontaminate(spark, sf).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    whole = {(a + i, i) for a in (100, 400) for i in range(8)} | {(500, 20)}
    assert whole <= pairs
    assert {p for p in pairs if p not in whole} <= {(200 + i, i) for i in range(8)}
    assert len(pairs) >= len(whole) + 6  # one changed word leaves over 0.8 of most items
    clean = d.decontaminated(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
    assert {r["doc_id"] for r in clean.collect()} == {r[0] for r in rows} - {a for a, _ in pairs}


def test_blocks_find_all_fingerprints_in_radius(spark):
    import random

    from pyspark.sql import functions as F

    random.seed(4)
    prints = []
    for _ in range(200):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), random.randint(0, d.RADIUS)):
            b ^= 1 << bit
        prints.append(tuple(x - 2**64 if x >= 2**63 else x for x in (a, b)))
    df = spark.createDataFrame(prints, "a long, b long")
    same = F.exists(F.arrays_zip(d.blocks(F.col("a"), d.RADIUS).alias("x"), d.blocks(F.col("b"), d.RADIUS).alias("y")), lambda z: z["x"] == z["y"])
    assert df.filter(~same).count() == 0


def test_copied_rare_part_among_other_boilerplate(spark, tmp_path):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    items = [(i, f"{words('common', 60)} {words(f'rare{i}x', 50)}") for i in range(8)]
    rows = [(i, words("common", 60), "a") for i in range(4000)]
    rows += [(5000 + i, f"{words(f'other{i}y', 60)} {words(f'rare{i}x', 50)}", "a") for i in range(8)]
    sf = write(spark, tmp_path, documents(spark, rows), benchmark=items)
    out = d.leaks(load(spark, sf, "documents"), load(spark, sf, "benchmark")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(5000 + i, i) for i in range(8)}
    assert max(r["hamming"] for r in out) > d.RADIUS and min(r["similarity"] for r in out) >= 0.8


def test_leak_edges(spark, tmp_path):
    sf = write(spark, tmp_path, documents(spark), benchmark=[(1, prose(40, 5)), (1, prose(40, 5)), (2, prose(30, 6))])
    out = d.decontaminated(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
    assert out.count() == 10 and out.filter('doc_id is null').count() == 1
    empty = write(spark, tmp_path / "none", documents(spark))
    assert d.op10_decontaminate(spark, empty).count() == 0
    assert d.decontaminated(load(spark, empty, "documents"), load(spark, empty, "benchmark")).count() == 12
