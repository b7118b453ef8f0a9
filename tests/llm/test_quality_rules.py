import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm import quality_rules as Q

from .helpers import EDGES, edge_docs, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    marked = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(marked)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c\x85\xa0é#|", max_size=120))
def test_stats(t):
    assert Q.text_stats(t)[0] == brute(t)


def test_repeats():
    for t in ("a b c d e f g h " * 3, "a " * 30, "x y " + "a b c d e f g h i " + "q " + "a b c d e f g h i", "1 2 3"):
        assert Q.text_stats(t)[0] == brute(t)


def _data(n=3000):
    rng = np.random.default_rng(1)
    x = rng.random((n, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.standard_normal(n) < 0.6).astype(float)
    return x, y


def test_monotone_and_accurate():
    x, y = _data()
    forest = Q.fit_forest(x[:2000], y[:2000], [-1, 0, 0])
    assert ((forest.score(x[2000:]) > 0) == (y[2000:] > 0.5)).mean() > 0.8
    base = np.random.default_rng(2).random((50, 3))
    grid = np.linspace(0, 1, 40)
    for row in base:
        z = np.tile(row, (40, 1))
        z[:, 0] = grid
        assert (np.diff(forest.score(z)) <= 1e-12).all()


def test_flat_scores_equal_walk():
    x, y = _data(500)
    f = Q.fit_forest(x, y, [0, 0, 0], trees=5)
    for row, got in zip(x[:50], f.score(x[:50]), strict=True):
        total = f.start
        for t in range(5):
            k = 0
            while f.left[t][k] != k:
                k = f.left[t][k] if row[f.feature[t][k]] <= f.threshold[t][k] else f.right[t][k]
            total += f.value[t][k]
        assert abs(total - got) < 1e-9


def test_edges(spark):
    labels = spark.createDataFrame([(5, 1), (7, 0), (None, 1), (8, None)], "doc_id long, quality int")
    got = Q.quality_rules(edge_docs(spark), labels).collect()
    want = sorted((str(i), *brute(t)) for i, t, _ in EDGES)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert Q.quality_rules(empty_docs(spark), labels).count() == 0
    none = Q.quality_rules(edge_docs(spark), labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    forest = Q.train(docs, labels.filter("doc_id % 2 = 0"))
    right = Q.apply_rules(docs, forest).withColumnRenamed("quality", "p").join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in right) / len(right) > 0.97
