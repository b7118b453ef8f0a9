import re
import time
from collections import Counter
from html import unescape
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm import html_extract as X
from convoloom.llm.html_tree import Page
from convoloom.llm.labelled_pages import labelled_pages

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return X.standard_model()


def f1(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    return 2 * sum((a & b).values()) / max(1, a.total() + b.total()) if a or b else 1.0


def tree(html):
    p = Page(html)
    return [(p.tag[i], p.parent[i]) for i in range(1, len(p.tag))]


def all_text(html):
    return " ".join("".join(" " if n < 0 else t for n, t in Page(html).runs).split())


def test_broken_markup():
    assert tree("<p>a<p>b<ul><li>x<li>y</ul>") == [("p", 0), ("p", 0), ("ul", 0), ("li", 3), ("li", 3)]
    assert tree("<table><tr><td>a<td>b<tr><td>c</table><p>d") == [("table", 0), ("tr", 1), ("td", 2), ("td", 2), ("tr", 1), ("td", 5), ("p", 0)]
    assert all_text("<p><b>one<br><p>two</p>") == "one two" and all_text("a<b>b</b>c &amp; &eacute;&#233;&nbsp;x") == "abc & éé x"
    assert all_text("x < y and <!-- <p>no</p> --> z<!-- open") == "x < y and z" and all_text("<!-->a<!x>b<?y>c</>d") == "abcd"
    assert all_text('<p title="a>b" class=\'c\' id=d/>t</p>') == "t" and Page('<p title="a>b" class=\'c\' id=d>').names[1].split() == ["c", "d"]
    assert all_text("a<b") == "a" and all_text("x<script>if (a<b) '</p>'") == "x" and all_text("") == "" and all_text("\x00<\x00>") == "\x00<\x00>"
    assert tree("<div><td>a</div>b</td></section></p>")[0] == ("div", 0) and Page("<div hidden><p style='display : NONE'>").hidden == [False, True, True]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div class='x'>", "</div>", "<li>", "<table>", "<td>", "</table>", "text ", "<!--", "-->", "<", ">", '"', "<a href=\"", "</", "&lt;", "<script>", "</script>", "<br/>"])).map("".join))
def test_any_markup_is_read(html):
    p = Page(html)
    assert all(up < i for i, up in enumerate(p.parent)) and all(n < len(p.tag) for n, _ in p.runs)
    f = X.Forest([html, "", html])
    assert len(f.runs) == 3 and f.features.max() < X.FEATURES


def test_broken_pages_take_linear_time():
    for piece in ("<div>", "<a href=\"x", "<p><b>", "<", "<!--", "<table><td>", "</div>", "&amp"):
        began = time.time()
        Page(piece * 30_000)
        assert time.time() - began < 5, piece


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 8))
def test_marginals_equal_all_states(seed, n):
    """Sums over every assignment of a tree's elements."""
    r = np.random.default_rng(seed)
    html, depth = "", 0
    for _ in range(n):
        while depth and r.random() < 0.4:
            html, depth = html + "</div>", depth - 1
        html, depth = html + "<div>" + "w " * r.integers(0, 9), depth + 1
    f = X.Forest([html])
    w, pair = r.normal(0, 1, X.FEATURES), r.normal(0, 1, (len(X.KINDS) * 18, 2, 2))
    p, both, z = X.marginals(f, w, pair)
    local = w[f.features].sum(1)
    weights, total = np.zeros(len(f.parent)), 0.0
    joint = np.zeros_like(both)
    for state in product((0, 1), repeat=len(f.parent)):
        score = sum(local[i] * s for i, s in enumerate(state)) + sum(pair[f.between[i], state[f.parent[i]], state[i]] for i in range(1, len(state)))
        e = np.exp(score)
        total += e
        weights += e * np.array(state)
        for i in range(1, len(state)):
            joint[i, state[f.parent[i]], state[i]] += e
    assert np.allclose(p, weights / total) and np.allclose(both, joint / total) and np.isclose(z, np.log(total))


def test_labels_of_runs_that_match_by_chance():
    runs = [(1, "a"), (-1, ""), (2, "a b c"), (3, "x")]
    assert X.run_labels(runs, "a b c x") == [False, False, True, True]
    assert X.run_labels(runs, "") == [False] * 4 and X.run_labels([], "a") == []


def test_gradient_is_that_of_the_likelihood():
    """Training raises the likelihood of labels: its steps follow observed less expected counts."""
    pages = labelled_pages(30, 3)
    f = X.Forest([h for h, _ in pages])
    label = X.node_labels(f, [t for _, t in pages]).astype(int)

    def likelihood(w, pair):
        low = np.flatnonzero((f.parent >= 0) & ~f.never)
        own = np.where(f.never, X.NEVER, w[f.features].sum(1))
        return (own * label).sum() + pair[f.between[low], label[f.parent[low]], label[low]].sum() - X.marginals(f, w, pair)[2]

    start = likelihood(np.zeros(X.FEATURES), np.zeros((len(X.KINDS) * 18, 2, 2)))
    few, more = (likelihood(*X.train(pages, steps)) for steps in (5, 60))
    assert start < few < more < 0


def test_held_out_pages(model):
    pages = labelled_pages(200, 77)
    got = X.main_texts([h for h, _ in pages], *model)
    assert np.mean([f1(g, t) for g, (_, t) in zip(got, pages, strict=True)]) > 0.98


def test_hand_written_pages(model):
    cases = {
        '<article><h1>Title of it</h1><p>First long paragraph here, with words enough to be text.</p><aside>Related: <a href=x>one</a></aside><div class="ad">Buy now, really.</div>'
        '<p>Second &amp; more.</p><p>Ok.</p></article><section id="comments"><div class="comment"><p>I liked this very much, and so did all of my friends who read it.</p></div></section>':
        "Title of it First long paragraph here, with words enough to be text. Second & more. Ok.",
        "<main><h1>T</h1><p>Short.</p><p>Text one two three four five six, seven.</p></main><div class='comments'><p>Nice text with many words in it, thanks a lot for it.</p></div><footer><p>All rights reserved.</p></footer>":
        "T Short. Text one two three four five six, seven.",
        "<h1>Only</h1><p>Just some paragraphs of text without anything around it, that should be kept.</p><p>Another.</p>":
        "Only Just some paragraphs of text without anything around it, that should be kept. Another.",
        '<div id="page"><nav class="menu"><a href=a>A</a></nav><div class="post"><div class="post-content"><div>Line one of text<br>Line two of text</div><div class="share-buttons"><a href=x>Tweet</a></div>'
        '<table><tr><td>cell a<td>cell b</table></div><ol class="commentlist"><li class="comment"><p>Reader says something long enough to be prose, yes.</p></li></ol></div></div>':
        "Line one of text Line two of text cell a cell b",
        "<h1>A page</h1><p>some words of text, long enough.</p><p>And more of them, in a second paragraph of the page.</p><script>var a = '<p>no</p>'</script><style>p{}</style><p hidden>no</p><noscript>no</noscript>": "A page some words of text, long enough. And more of them, in a second paragraph of the page.",
    }
    assert X.main_texts(list(cases), *model) == list(cases.values())


def test_pages_of_the_table(spark):
    """All that stands in each page's article, by patterns."""
    rows = X.extract_text(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(unescape(re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inside))).split()) and r["n_chars"] == len(r["text"])
    assert len(rows) == len(pages)


def test_edges(spark):
    long = "<article>" + "<p>word word word, and more.</p>" * 20_000 + "</article>"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "<p>the same text, twice over</p>"), (4, "<p>the same text, twice over</p>"), (None, "<h1>plain</h1> text that has no end, and <b>goes on for some words</b> more."), (5, long), (6, "<nav><a href=x>a</a></nav>")]
    df = spark.createDataFrame([(i, "u", h, "x", 1) for i, h in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["n_chars"], r["text"][:20]) for r in X.extract_text(df).collect()}
    assert got == {(1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 25, "the same text, twice"), (None, 60, "plain text that has "), (5, 26 * 20_000 - 1, "word word word, and "), (6, 0, "")}
    assert X.extract_text(df).count() == 8 and X.extract_text(df.limit(0)).collect() == []


def test_own_labelled_pages(spark):
    """A model of pages whose content stands in tables named x."""
    pages = [(f"<div class=post><p>{'no ' * i}</p></div><section><p>{'yes ' * i}</p></section>", "yes " * i) for i in range(1, 40)]
    df = spark.createDataFrame([(1, "u", pages[9][0])], "page_id long, url string, html string")
    assert X.extract_text(df, labelled=pages).first()["text"] == pages[9][1].strip()
