"""Main text of pages: a tree-structured model of the elements, with marginals by sum-product messages up and down.

Each element is content or not. Its own features give a potential; its kind and what its parent is named give a potential with the
parent's state. Messages go from the leaves to the root and back, a depth at a time for all pages of a batch, which gives exact
marginals. The weights maximise the likelihood of labelled pages, whose gradient is made of the same marginals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_tree import INLINE, UNSEEN, Page
from .labelled_pages import labelled_pages
from .memory import bounded, tidy

KINDS = ("inline", "link", "heading", "paragraph", "list", "item", "table", "box", "article", "edge", "form", "root")
_KIND = {k: i for i, k in enumerate(KINDS)}
_OF_TAG = (
    {t: "inline" for t in INLINE} | {"a": "link"} | {f"h{i}": "heading" for i in range(1, 7)}
    | {t: "paragraph" for t in "p blockquote pre figcaption dd dt summary q address center".split()}
    | {t: "list" for t in "ul ol dl menu".split()} | {"li": "item"}
    | {t: "table" for t in "table tbody thead tfoot tr td th caption".split()}
    | {t: "article" for t in ("article", "main")} | {t: "edge" for t in "nav aside footer header dialog".split()}
    | {t: "form" for t in "form fieldset label legend input output".split()} | {t: "root" for t in ("html", "body")}
)

# Words in class, id and role that tell what a part of a page is for.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted banner commercial teaser outbrain taboola "
    "nav navbar navigation menu topnav breadcrumb breadcrumbs pagination pager toolbar tabs toc sitemap skip "
    "header masthead topbar logo branding footer colophon copyright legal credits bottom "
    "sidebar aside side rail widget widgets related recommended recommendations popular trending more secondary "
    "cookie cookies consent gdpr privacy notice alert popup modal overlay announcement message warning newsletter subscribe subscription paywall dialog "
    "comment comments commentlist response responses respond reply replies discussion disqus feedback reviews "
    "bar top strip ticker share sharing social follow tags meta byline print tools login signup signin search form contentinfo complementary".split()
)
CONTENT = frozenset("content article post entry story main body text hentry prose maincontent".split())
#: A name of several words is about its last known word, but for these, which rule wherever they stand.
ALWAYS = frozenset("ad ads advert advertisement sponsored promo comment comments commentlist sidebar cookie consent newsletter share social related breadcrumb breadcrumbs footer nav menu notice".split())

WORDS, LINKS, SHARE = (0, 1, 3, 10, 30, 100), (0.001, 0.3, 0.7), (0.01, 0.05, 0.2, 0.5)
#: First feature of each group; in a group one feature of an element is on.
GROUPS = {"bias": 1, "kind": len(KINDS), "named": 3, "inherited": 3, "own": len(WORDS) + 1, "all": len(WORDS) + 1, "links": len(LINKS) + 2, "share": len(SHARE) + 2, "marks": 4}
FIRST = dict(zip(GROUPS, np.cumsum([0, *GROUPS.values()])[:-1].tolist(), strict=True))
FEATURES = sum(GROUPS.values())
#: Log potential of being content for what a browser does not show.
NEVER = -60.0
PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


@lru_cache(maxsize=1 << 14)
def told(names: str) -> int:
    """What names of an element say: 0 nothing, 1 around the content, 2 content."""
    out = 0
    for name in names.split():
        parts = [p.lower() for p in PART.findall(name)]
        if any(p in ALWAYS for p in parts):
            return 1
        known = [p for p in parts if p in AROUND or p in CONTENT]
        if known and known[-1] in AROUND and not (out == 2 and known[-1] in ("more", "side", "bottom", "meta", "tools")):
            return 1
        if known:
            out = 2
    return out


class Forest:
    """The elements of some pages as arrays: parents, depths, kinds, features, and which text runs belong to which element."""

    def __init__(self, pages: list[str]):
        parent, kind, named, inherited, never, own, linked = [], [], [], [], [], [], []
        self.runs: list[list[tuple[int, str]]] = []
        sizes = []
        for html in pages:
            page, base = Page(html), len(parent)
            for i, (up, tag, names, hidden) in enumerate(zip(page.parent, page.tag, page.names, page.hidden, strict=True)):
                k = _OF_TAG.get(tag, "box")
                say = told(names) if names and k != "root" else 0
                above = inherited[base + up] if i else 0
                # An article among comments is one of them, and a header in the content belongs to it.
                say = say or (above != 2 if tag == "header" else 1 if k in ("edge", "form") else 2 * (above != 1) if k == "article" else 0)
                parent.append(base + up if i else -1)
                kind.append(_KIND[k])
                named.append(say)
                inherited.append(say or above)
                never.append(hidden or tag in UNSEEN or (i > 0 and never[base + up]))
                own.append(0)
                linked.append(k == "link" or (i > 0 and linked[base + up]))
            for node, text in page.runs:
                if node >= 0 and (n := len(text.split())):
                    own[base + node] += max(n, len(text) // 12)
            self.runs.append([(base + node if node >= 0 else -1, text) for node, text in page.runs])
            sizes.append(len(parent) - base)
        self.parent, self.kind, self.named = np.array(parent, int), np.array(kind, int), np.array(named, int)
        self.inherited, self.never = np.array(inherited, int), np.array(never, bool)
        own, linked = np.where(self.never, 0, np.array(own, float)), np.array(linked, bool)
        self.first = np.cumsum([0, *sizes])[:-1].astype(int)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        depth = np.zeros(len(parent), int)
        for i, up in enumerate(parent):
            depth[i] = depth[up] + 1 if up >= 0 else 0
        order = np.argsort(depth, kind="stable")
        cuts = np.flatnonzero(np.diff(depth[order])) + 1
        self.levels = np.split(order, cuts) if len(order) else []
        self._features(own, own * linked)

    def _sums(self, x: np.ndarray) -> np.ndarray:
        """Sums over what is below each element and itself."""
        x = x.copy()
        for level in self.levels[:0:-1]:
            np.add.at(x, self.parent[level], x[level])
        return x

    def _features(self, own: np.ndarray, linked: np.ndarray) -> None:
        below, links = self._sums(own), self._sums(linked)
        page = below[self.first][self.page] if len(self.first) else below
        inner = np.isin(self.kind, (_KIND["inline"], _KIND["link"]))
        block = own.copy()  # text of a block with that of the inline elements in it
        for level in self.levels[:0:-1]:
            some = level[inner[level]]
            np.add.at(block, self.parent[some], block[some])
        share = np.where(below > 0, links / np.maximum(below, 1), 0)
        holds = np.isin(self.kind, [_KIND[k] for k in ("list", "table", "box", "article", "edge", "form", "root")])
        columns = {
            "bias": np.zeros(len(own), int), "kind": self.kind, "named": self.named, "inherited": np.where(self.parent >= 0, self.inherited[self.parent], 0),
            "own": np.searchsorted(WORDS, block), "all": np.searchsorted(WORDS, below),
            "links": np.where(below > 0, 1 + np.searchsorted(LINKS, share, side="right"), 0), "share": np.where(holds, 1 + np.searchsorted(SHARE, below / np.maximum(page, 1), side="right"), 0),
            "marks": 2 * (self.kind == _KIND["paragraph"]) + (block >= 10),
        }
        self.features = np.stack([columns[g] + FIRST[g] for g in GROUPS], 1)
        line = np.isin(self.kind, [_KIND[k] for k in ("inline", "link", "heading", "paragraph", "item")])
        self.between = np.where(self.parent >= 0, (self.kind * 2 + line[self.parent]) * 9 + self.inherited[self.parent] * 3 + self.named, 0)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(np.take(a, 0, axis), np.take(a, 1, axis))


def marginals(f: Forest, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of content for each element, of each pair of states with its parent's, and the log normaliser of all pages.

    ``pair`` has [kind of link, parent's state, own state]. Messages go up a depth at a time, and then down."""
    up = np.zeros((len(f.parent), 2))
    up[:, 1] = np.where(f.never, NEVER, weights[f.features].sum(1))
    edge = np.where(f.never[:, None, None], 0.0, pair[f.between])  # what is not shown tells nothing
    message = np.zeros_like(up)
    for level in f.levels[:0:-1]:
        message[level] = _lse(edge[level] + up[level][:, None, :], 2)
        for state in (0, 1):
            np.add.at(up[:, state], f.parent[level], message[level, state])
    down = np.zeros_like(up)
    for level in f.levels[1:]:
        rest = up[f.parent[level]] + down[f.parent[level]] - message[level]
        down[level] = _lse(edge[level] + rest[:, :, None], 1)
    whole = up + down
    z = _lse(whole, 1)
    both = np.zeros((len(up), 2, 2))
    if len(f.levels) > 1:
        low = np.concatenate(f.levels[1:])
        rest = up[f.parent[low]] + down[f.parent[low]] - message[low]
        both[low] = np.exp(edge[low] + up[low][:, None, :] + rest[:, :, None] - z[low][:, None, None])
    return np.exp(whole[:, 1] - z), both, z[f.first].sum() if len(f.first) else 0.0


def run_labels(runs: list[tuple[int, str]], text: str) -> list[bool]:
    """Which runs of a page make up its main text, read in order and without white space.

    A run may equal the next part of the text by chance, so both readings are followed; the one that covers most of the text counts."""
    rest = "".join(text.split())
    ways: dict[int, tuple] = {0: ()}  # length covered: the runs that cover it, the last first
    for i, (node, piece) in enumerate(runs):
        piece = "".join(piece.split()) if node >= 0 else ""
        if piece:
            ways |= {at + len(piece): (i, way) for at, way in ways.items() if rest.startswith(piece, at)}
    way, out = ways[max(ways)], [False] * len(runs)
    while way:
        i, way = way
        out[i] = True
    return out


def node_labels(f: Forest, texts: list[str]) -> np.ndarray:
    """An element is content if most of its own text is, or without text of its own most of what is below; else as its parent."""
    size = np.zeros((len(f.parent), 2))
    for runs, text in zip(f.runs, texts, strict=True):
        for (node, piece), main in zip(runs, run_labels(runs, text), strict=True):
            if node >= 0:
                size[node, int(main)] += len("".join(piece.split()))
    size[f.never] = 0
    total = np.stack([f._sums(size[:, 0]), f._sums(size[:, 1])], 1)
    label = np.where(size.sum(1) > 0, size[:, 1] > size[:, 0], total[:, 1] > total[:, 0])
    for level in f.levels[1:]:
        empty = level[total[level].sum(1) == 0]
        label[empty] = label[f.parent[empty]]
    return label & ~f.never


def train(pages: list[tuple[str, str]], steps: int = 250, rate: float = 0.3, shrink: float = 0.0002) -> tuple[np.ndarray, np.ndarray]:
    """Weights of features and of pairs that maximise the likelihood of labelled pages, by gradient steps of adapted, falling size."""
    f = Forest([html for html, _ in pages])
    label = node_labels(f, [text for _, text in pages]).astype(int)
    low = np.flatnonzero((f.parent >= 0) & ~f.never)
    seen = np.bincount(f.features[~f.never].ravel(), np.repeat(label[~f.never], f.features.shape[1]), FEATURES)
    links = len(KINDS) * 18
    cells = f.between[low] * 4 + label[f.parent[low]] * 2 + label[low]
    pairs = np.bincount(cells, minlength=links * 4).reshape(links, 2, 2)
    x = np.zeros(FEATURES + links * 4)
    first, second = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        p, both, _ = marginals(f, x[:FEATURES], x[FEATURES:].reshape(links, 2, 2))
        expected = np.bincount(f.features[~f.never].ravel(), np.repeat(p[~f.never], f.features.shape[1]), FEATURES)
        joint = np.bincount((f.between[low][:, None] * 4 + np.arange(4)).ravel(), both[low].ravel(), links * 4).reshape(links, 2, 2)
        gradient = np.concatenate([seen - expected, (pairs - joint).ravel()]) / len(pages) - shrink * x
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        x += rate * (1 - t / (steps + 1)) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return x[:FEATURES], x[FEATURES:].reshape(links, 2, 2)


@lru_cache(maxsize=2)
def standard_model(pages: int = 400, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The model of the generated labelled pages."""
    return train(labelled_pages(pages, seed))


def main_texts(pages: list[str], weights: np.ndarray, pair: np.ndarray, least: float = 0.5) -> list[str]:
    """Main texts of pages: the runs of elements that are content with a probability of ``least`` or more, in page order."""
    f = Forest(pages)
    content = marginals(f, weights, pair)[0] >= least
    keep = (content & ~f.never).tolist()
    return [" ".join("".join(" " if node < 0 else text for node, text in runs if node < 0 or keep[node]).split()) for runs in f.runs]


def extract_text(
    pages: DataFrame, labelled: list[tuple[str, str]] | None = None, least: float = 0.5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page row: page_id, url, text (empty if there is none), n_chars (code points of the text).

    ``labelled`` has (html, main text) pairs to train on, and 400 generated pages stand in for it. It has to fit the driver; its
    size does not depend on ``pages``. Null and empty pages, and pages without content, have an empty text; broken markup is read
    as far as it goes; whole pages are read at any length; repeated rows and null ids stay; an empty table gives no rows; other
    columns are not looked at. One pass without a shuffle; workers hold an Arrow batch of pages.
    """
    weights, pair = train(labelled) if labelled is not None else standard_model()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield pd.Series(main_texts(html.tolist(), weights, pair, least), dtype=object)
        tidy()

    read = bounded(pages).select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("h"))
    return read.select("page_id", "url", text("h").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
