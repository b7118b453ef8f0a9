import hashlib
import re
import time
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm import periodic_runs as P

from .helpers import EDGES, LONG, edge_docs, empty_docs


def brute_runs(w, least=12):
    """Every period, every maximal stretch of equal words at that distance."""
    seen, out = set(), []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_z(a):
    return [next((k for k in range(len(a) - i) if a[i + k] != a[k]), len(a) - i) for i in range(len(a))]


def brute_row(key, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if key is not None and (h := crc32(str(key).encode())) % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        key, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80))
def test_z_function(a):
    z = P.z_function(np.array(a, np.int64))
    assert z.tolist() == brute_z(a)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 40)), min_size=1, max_size=8), st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=5), min_size=4, max_size=4))
def test_z_function_of_repetitions(order, pieces):
    a = [x for p, k in order for x in pieces[p] * k]
    assert P.z_function(np.array(a, np.int64)).tolist() == brute_z(a)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=8), st.sampled_from([2, 5, 12]))
def test_runs_of_repeated_pieces(pieces, least):
    a = [x for p, k in pieces for x in p * k]
    assert [tuple(r) for r in P.word_runs(np.array(a, np.int64), least).tolist()] == brute_runs(a, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=150))
def test_runs_of_two_words(a):
    assert [tuple(r) for r in P.word_runs(np.array(a, np.int64)).tolist()] == brute_runs(a)


def test_long_periodic_texts_take_little_time():
    for period in (1, 7, 5000):
        a = np.concatenate([np.arange(100), np.arange(200_000) % period, np.arange(100)])
        began = time.time()
        runs = P.word_runs(a)
        assert runs[:, 1].max() >= 200_000 and time.time() - began < 20


def test_digests_equal_brute_force(spark):
    rows = EDGES + [(i, " ".join(f"w{x % (3 + i % 5)}" if i % 3 else f"v{x * x % 97}" for x in range(i)), "en") for i in range(20, 160)]
    rows = [r for r in rows if r[1] is not LONG]
    rows += [(i, "one two three " * 9 + "four " * 30 + "five", "en") for i in (1001, 1001)]
    got = sorted((tuple(r) for r in P.run_digests(edge_docs(spark, rows)).collect()), key=str)
    assert got == sorted((brute_row(i, t) for i, t, _ in rows), key=str)
    assert P.run_digests(empty_docs(spark)).collect() == []


def test_planted_tails_of_long_texts(spark):
    ids = [i for i in range(200) if crc32(str(i).encode()) % 10 == 0][:4]
    rows = [(i, " ".join(f"w{x * 7919 % 9973}" for x in range(2000)), "en") for i in ids]
    got = sorted(tuple(r) for r in P.run_digests(edge_docs(spark, rows)).collect())
    assert got == sorted(brute_row(i, t) for i, t, _ in rows) and all(r[1] for r in got)


def test_runs_and_collapsed_texts(spark):
    docs = edge_docs(spark, EDGES + [(9, "a b c " * 5 + "end", "en")])
    found = {r["doc_id"]: r for r in P.find_runs(docs).collect()}
    assert [tuple(x) for x in found[9]["runs"]] == [(0, 15, 3)] and found[9]["n_words"] == 16 and found[5]["n_words"] == 30_000
    out = P.collapse_runs(docs)
    texts = [r["text"] for r in out.filter("doc_id = 9 or doc_id is null").orderBy("doc_id").collect()]
    assert texts == ["a text without an id but with some words in it", "a b c end"] and out.columns == docs.columns
    assert out.filter("text is null").count() == 1 and P.collapse_runs(empty_docs(spark)).count() == 0
