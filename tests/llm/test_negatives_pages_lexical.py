"""Hard negatives, page text and lexical search against brute force, on small tables with every awkward case."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus as C
from strata.llm import html_text, lexical, negatives

VECTORS = "vec_id long, embedding array<double>, label int, id long, vec string, w int"


# --- 11 hard negatives
def plain_negatives(rows, every=100, positives=5, negatives_=5):
    """{(anchor, positive): [(negative, scores)]} by scoring everything."""
    kept = []
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    anchors = {}
    for i, label, v in kept:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, u, strict=True)), i, other) for i, other, u in kept if i != a and len(u) == len(v)]
        best = sorted((s, i) for s, i, other in scored if other == label)[:positives]
        for n, (ps, p) in enumerate(best):
            own = sorted((s, i) for s, i, other in scored if other != label and 80 * -ps <= 100 * -s <= 100 * -ps)
            out += [(a, p, r + 1, i, -ps, -s, n + 1) for r, (s, i) in enumerate(own[:negatives_])]
    return Counter(out)


def vectors(seed, n, dims, spread=1.0):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=dims) * spread).tolist(), int(rng.integers(4)), 1, "x", 2) for i in range(n)]
    same = rows[17][1]
    rows += [(n + i, same, i % 3, None, None, None) for i in range(60)]            # copies tie
    rows += [rows[100], rows[5], rows[5]]                                            # repeated rows
    rows += [(200, None, 1, 0, "", 0), (300, same, None, 0, "", 0), (None, same, 1, 0, "", 0), (400_000, [], 1, 0, "", 0),
             (500_000, [None] + same[1:], 1, 0, "", 0), (600_000, [float("nan")] + same[1:], 1, 0, "", 0),
             (700_000, [float("inf")] + same[1:], 1, 0, "", 0), (800_000, same[:-1], 1, 0, "", 0), (800_001, same[:-1], 2, 0, "", 0),
             (800_002, same[:-1], 1, 0, "", 0), (900_000, [0.0] * dims, 0, 0, "", 0), (900_001, [0.0] * dims, 0, 0, "", 0)]
    return rows


def moved_label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))


@pytest.mark.parametrize(("dims", "spread", "cells"), [(16, 1.0, 1 << 18), (3, 1.0, 5), (24, 1e14, 1 << 18)])
def test_negatives_match_full_scoring(spark, dims, spread, cells):
    """Also with anchors in many blocks, and with scores beyond 2^53 (as Python integers)."""
    rows = vectors(3, 700, dims, spread)
    if spread > 1:
        rows = [(i, v and [x and x * 1e-13 if k % 2 and math.isfinite(x) else x for k, x in enumerate(v)], *r) for i, v, *r in rows]
        rows = [r for r in rows if r[0] is None or r[0] < 500]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = negatives.mine(df, F.col("id") % 100 == 0, label=moved_label(), anchor_cells=cells).collect()
    expected = plain_negatives(rows)
    if spread > 1:  # scores beyond 64 bits are given as the nearest long
        clamp = lambda s: min(max(s, negatives.LONG_MIN), negatives.LONG_MAX)
        expected = Counter((a, p, r, n, clamp(x), clamp(y), k) for a, p, r, n, x, y, k in expected.elements())
        got = [r for r in got if abs(r["positive_score"]) < negatives.LONG_MAX]
        expected = Counter({k: v for k, v in expected.items() if abs(k[4]) < negatives.LONG_MAX})
    assert Counter(tuple(r) for r in got) == expected


def test_negatives_of_an_empty_table(spark):
    out = negatives.mine(spark.createDataFrame([], VECTORS), F.col("id") % 100 == 0)
    assert out.columns[:6] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert out.collect() == []


def test_bond_prunes_and_loses_nothing():
    rng = np.random.default_rng(5)
    columns = np.floor(256 * rng.normal(size=(32, 3000)) * np.linspace(2, 0.05, 32)[:, None])
    anchor = columns[:, 0]
    exact = anchor @ columns
    top = np.sort(exact)[::-1][:5]
    ((rows, scores),) = negatives.bond(columns, columns.min(1), columns.max(1), anchor, np.arange(3000), [(-np.inf, np.inf)], 5, [None])
    assert sorted(scores)[::-1][:5] == top.tolist()
    assert len(rows) < 50
    np.testing.assert_array_equal(scores, exact[rows])


@pytest.mark.parametrize("score", [0, 1, 7, 99, 100, 101, -1, -10])
def test_window_is_exact(score):
    a, b = negatives.window(score)
    assert [s for s in range(-200, 201) if a <= s <= b] == [s for s in range(-200, 201) if 80 * score <= 100 * s <= 100 * score]


# --- 12 page text
def plain_cut(odds, edges):
    """The least content among all labellings of least cost."""
    def cost(side):
        out = sum(max(c, 0) for c, s in zip(odds, side, strict=True) if not s) + sum(max(-c, 0) for c, s in zip(odds, side, strict=True) if s)
        return out + sum(c for a, b, c in edges if side[a] != side[b])
    return min(itertools.product([False, True], repeat=len(odds)), key=lambda side: (cost(side), sum(side)))


def test_minimum_cut_matches_enumeration():
    rng = random.Random(7)
    for _ in range(150):
        n = rng.randint(1, 9)
        odds = [rng.choice([0, rng.randint(-9, 9), rng.randint(-3, 3)]) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 6)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        assert html_text.min_cut(odds, edges) == list(plain_cut(odds, edges))


PROSE = "This is a sentence of the article that goes on for a while, so that it looks like prose. And another one follows it."
SOUP = f"""<!doctype html><html><head><title>No</title><meta charset=utf-8><style>p > a {{}}</style></head>
<body class="has-sidebar"><!-- <p>hidden</p> --><div id=top-menu><a href=/>Home</a> <a href=/x>News</a></div>
<div class="cookie-notice"><p>{PROSE} We use cookies on this site to make it better for everyone.</p></div>
<div class=content><h1>Title &amp; more</h1><p>{PROSE}<p>Short &lt;b&gt;.<br>Next <b>bo</b>ld&nbsp;&#233;&eacute
<ul><li>{PROSE}</ul><script>document.write("<p>script</p>")</script><p>{PROSE}</p>
<div class="ad"><p>{PROSE}</p></div><p>End.</p>
<form action=/s><label>Name</label><input><select><option>one</select><textarea>area</textarea><button>Go</button></form></div>
<aside><p>{PROSE}</p></aside><section id="comments"><article><p>{PROSE}</p></article></section>
<div class="Footer">&copy; 2020 All rights</div><noscript>{PROSE}</noscript></body></html>"""


def test_page_without_semantic_tags():
    assert html_text.main_text(SOUP) == f"Title & more {PROSE} Short <b>. Next bold éé {PROSE} {PROSE} End."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("   \n", ""), ("<p></p>", ""), ("<nav><a href=x>a</a></nav><footer>f</footer>", ""),
    (f"<nav><p>{PROSE}</p></nav><main><p>{PROSE}</main><footer>{PROSE}</footer>", PROSE),
    (f"<article><header><h1>A</h1></header><p>{PROSE}</p><footer>{PROSE}</footer></article>", f"A {PROSE}"),
    (f"<article><p>{PROSE}</p><div class='comment-list'><p>{PROSE}</p></div></article>", PROSE),
    (f"<form id=whole><article><p>{PROSE}</p></article></form>", PROSE),
    (f"<article><p>{PROSE}</p><p style='display: none'>x</p></article>", PROSE),
    (f"<article><p>{PROSE}</p><p hidden>{PROSE}</p></article>", PROSE),
    (f"<article><p title='a > b' data-x=\"c>d\">{PROSE}</p><p>tail", f"{PROSE} tail"),
    (f"<article><p>{PROSE}</p><!-- open <p>{PROSE}", PROSE),
    (f"<article><p>{PROSE}</p><p class='cut", PROSE),
    (f"<article><p>{PROSE}</p><script>var x = '</p>", PROSE),
    (f"<article><h1>a &am</h1><p>1 < 2 & 3 > 2 &amp &notin; &#x41; {PROSE}</p></article>", f"a &am 1 < 2 & 3 > 2 & ∉ A {PROSE}"),
    (f"<article><p>a  b\t\n c</p><p>{PROSE}</p></article>", f"a b c {PROSE}"),
    (f"<ARTICLE><P>{PROSE}</P></ARTICLE><DIV CLASS='Ad-Slot'>{PROSE}</DIV>", PROSE),
])
def test_page_cases(page, text):
    assert html_text.main_text(page) == text


def test_pages_of_any_length_and_depth():
    n = 20_000
    assert html_text.main_text("<div>" * n + f"<article><p>{PROSE}</p></article>" + "</div>" * n) == PROSE
    assert html_text.main_text("<article>" + f"<p>{PROSE}" * n) == " ".join([PROSE] * n)
    alternating = "".join(f"<p>{PROSE}</p><div class=ad>{i}</div>" for i in range(3000))
    assert html_text.main_text(alternating) == " ".join([PROSE] * 3000)
    for broken in ("<a <b " * n, "<!--" * n, "<p x='" * n, '<p x="' * n + ">", "</p" * n, "<" * n, "&" * n, "<script>" * n):
        html_text.main_text(broken)


def test_extract_keeps_other_columns(spark):
    rows = [(1, "u", SOUP, "t", 5), (1, "u", SOUP, "t", 5), (None, None, None, None, None), (3, "", "", "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, _h_text string, `text x` int")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "url", "text x", "_h_text", "_h_chars"]
    found = Counter(tuple(r) for r in out.collect())
    text = html_text.main_text(SOUP)
    assert found == Counter({(1, "u", 5, text, len(text)): 2, (None, None, None, "", 0): 1, (3, "", 0, "", 0): 1})
    assert html_text.extract(df.limit(0)).collect() == []


# --- 13 lexical search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_rank(docs, items, k=10):
    held = [(d, Counter(plain_terms(t)), len(plain_terms(t))) for d, t in docs if plain_terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        wanted = set(plain_terms(text))
        scored = []
        for d, c, n in held:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def items(docs):
    rng = random.Random(9)
    texts = [" ".join((t or "").split()[:30]) for _, t in rng.sample(docs, 25)]
    texts += [None, "", "  ", "no such words zzzzzzz", "The THE the", "line one is here", "日本語 текст", "one", "ONE two", texts[0], docs[0][1] * 3]
    return [(i, t) for i, t in enumerate(texts)] + [(3, "ab one"), (None, "ab")]


@pytest.mark.parametrize("block_terms", [20_000, 30])
def test_lexical_matches_full_scoring(spark, block_terms):
    rows = C.rows()
    rows += [(500 + i, "ab one common words here", "en", "a", 1, 1, "c", 1, ["w"]) for i in range(300)]  # copies: ties by id
    docs = [(r[0], r[1]) for r in rows]
    queries = items(docs)
    got = lexical.rank(spark.createDataFrame(rows, C.SCHEMA).repartition(3),
                       spark.createDataFrame(queries, "item_id long, text string"), block_terms=block_terms).collect()
    expected = plain_rank(docs, queries)
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == expected


def test_lexical_of_empty_tables(spark):
    some = spark.createDataFrame(C.rows()[:5], C.SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert lexical.rank(some, none).collect() == []
    assert lexical.rank(some.limit(0), one).collect() == []
    assert lexical.rank(some.limit(0), one).columns == ["item_id", "rank", "doc_id", "score"]


def test_tree_prunes_and_shares_paths():
    """Skewed counts: most subtrees are left out, and the best documents are those of full scoring."""
    rng = np.random.default_rng(2)
    tf = (rng.random((4000, 60)) < np.linspace(0.7, 0.01, 60)).astype(np.int32) * rng.integers(1, 4, (4000, 60)).astype(np.int32)
    tf[:40, 40:50] += 5
    m = rng.integers(10, 300, 4000)
    tree = lexical.Tree.build(np.arange(4000), m, tf)
    assert len(tree.start) < 4000
    terms, weight = np.arange(40, 50), np.full(10, 1000)
    best: list = []
    seen = lexical.search_tree(tree, terms, weight, best, 10)
    own = lexical.scores(tf[:, terms], m, weight)
    assert sorted(best, reverse=True) == sorted(((s, -d) for d, s in enumerate(own.tolist())), reverse=True)[:10]
    assert seen < 2000
    for node, inner in enumerate(tree.children):
        a, b = tree.start[node], tree.end[node]
        assert (tree.top[node] == tree.tf[a:b].max(axis=0)).all() and tree.least[node] == tree.m[a:b].min()
        if len(inner):
            assert tree.start[inner].tolist() == [a, *tree.end[inner][:-1].tolist()] and tree.end[inner][-1] == b


def test_frequent_terms_first():
    assert lexical.terms_of("A-b_C ÄÖ 12ab\x00x".encode()) == [b"a", b"b", b"c", "ÄÖ".encode(), b"12ab", b"x"]
    groups = defaultdict(int)
    for c in range(256):
        groups[bool(lexical.terms_of(bytes([c])))] += 1
    assert groups[True] == 62 + 128
