import math
import zlib
from collections import Counter

import numpy as np

from convoloom.llm import lm_score as L

from .helpers import EDGES, edge_docs, empty_docs


def check_base(rows, got):
    mark = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter()
    for i, t, *_ in rows:
        if not mark(i):
            c.update([*L.words_of(t), b""])
    n, v = sum(c.values()), len(c)
    want = []
    for i, t, *_ in rows:
        w = [*L.words_of(t), b""]
        want.append((str(i), mark(i), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)))
    key = lambda r: (r[0], r[2], r[5])
    have = sorted(((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(have, sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)
    assert all(math.isfinite(r.score) and r.score <= 1e-6 for r in got)


def test_edges(spark):
    check_base(EDGES, L.score_documents(edge_docs(spark)).collect())
    assert L.score_documents(empty_docs(spark)).count() == 0
    alone = [(i, t, "en") for i, t in ((None, "only held out"), (None, ""))]
    check_base(alone, L.score_documents(edge_docs(spark, alone)).collect())


def test_tail_is_joined(spark, monkeypatch):
    """With a larger head share nearly all words take the shuffled way, to the same figures."""
    monkeypatch.setattr(L, "HEAD_SHARE", 0.05)
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(1, 40)) + " The", "en") for i in range(80)]
    check_base(rows, L.score_documents(edge_docs(spark, rows)).collect())


def test_scores_do_not_depend_on_the_layout(spark):
    """Several units, and vectors, buckets, words without a vector and unknown ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = []
    for parts in (4, 9):
        out = L.score_documents(docs.repartition(parts), unit_tokens=20_000).collect()
        got.append({r.doc_id: (r.base_score, r.score) for r in out})
    assert got[0].keys() == got[1].keys()
    assert all(math.isclose(x, y, rel_tol=1e-6) for i in got[0] for x, y in zip(got[0][i], got[1][i], strict=True))


def test_buckets_alike_in_both_languages(spark):
    words = ["a", "ab", "abc", "abcd", "é", "aé", "日本", "x" * 300, "ñandú"]
    got = spark.createDataFrame([(w,) for w in words], "word string").select("word", L.bucket_column(L.F.col("word")).alias("b")).collect()
    assert all(r.b == L.bucket_of(r.word.encode()) for r in got)


def test_words_of_a_bucket_sum_to_one():
    words = [f"w{i}".encode() for i in range(3000)]
    v = L.Vocabulary(words, np.arange(3000, 0, -1.0), 50, np.arange(L.BUCKETS, dtype=float))
    assert v.singles == L.SINGLES and len(v.class_of) == 3000 + L.BUCKETS and abs(v.unigram().sum() - 1) < 1e-9
    for w, code in zip(words, v.encoder()(words), strict=True):
        assert v.class_of[code] == (code if code < v.singles else v.singles + L.bucket_of(w)) and not v.is_rare[code]
    for w, code in zip((b"new", b"unseen"), v.encoder()([b"new", b"unseen"]), strict=True):
        assert v.is_rare[code] and v.class_of[code] == v.singles + L.bucket_of(w)
    assert all(v.entry_count[c - v.singles] == n for c, n in zip(v.code[v.singles :], v.counts[v.singles :], strict=True))
    m = L.start_inner(v)
    rng = np.random.default_rng(3)
    m = L.Inner(*[p + rng.standard_normal(p.shape).astype(np.float32) for p in m.parts()])
    z = m.sums(v.start)
    for b in (0, 5, v.v + 2):
        p = np.exp(m.entries @ m.context[b] + m.bias - z[b][v.bucket])
        assert np.allclose(np.add.reduceat(p, v.start[:-1]), 1, atol=1e-4)


def test_inner_model_learns_what_follows():
    words = [f"w{i}".encode() for i in range(L.SINGLES)] + [w for w in (f"x{i}ab".encode() for i in range(4))]
    v = L.Vocabulary(words, np.full(len(words), 100.0), 50, np.zeros(L.BUCKETS))
    m = L.start_inner(v)
    entry = np.sort(np.tile(v.code[-4:] - v.singles, 200))
    before = (entry - entry.min()).astype(np.int64)  # word i of the bucket follows class i
    share = v.entry_count / np.add.reduceat(v.entry_count, v.start[:-1])[v.bucket]
    squares = [np.zeros_like(p) for p in m.parts()]
    for nth in range(60):
        L.descend_inner(m, v.start, share, before, entry, np.ones(len(entry), np.float32), np.random.default_rng(nth), squares)
    z = m.sums(v.start)
    for i, e in enumerate(np.unique(entry)):
        assert np.exp(m.context[i] @ m.entries[e] + m.bias[e] - z[i, v.bucket[e]]) > 0.8


def test_normalised():
    rng = np.random.default_rng(0)
    m = L.start_model(np.array([0.3, 0.2, 0.2, 0.2, 0.1]))
    m = m.filled(rng.standard_normal(m.flat().size))
    z = m.sums()
    one, two = m.contexts()
    for a in range(m.v + 3):
        for b in range(m.v + 3):
            p = np.exp((one[b] + two[a]) @ m.outputs.T + m.bias - z[a, b])
            assert abs(p.sum() - 1) < 1e-3


def test_learns_order():
    """Noise-contrastive steps find that b follows a."""
    ids = [np.array([0, 1] * 10, np.int32) for _ in range(200)]
    unigram = np.array([0.45, 0.45, 0.05, 0.05])
    m = L.start_model(unigram)
    state = {"m1": [np.zeros_like(p) for p in m.parts()], "m2": [np.zeros_like(p) for p in m.parts()], "t": [np.zeros(1)]}
    a, b, w, _ = L.windows(ids, 2)
    rng = np.random.default_rng(1)
    for _ in range(20):
        order = rng.permutation(len(w))
        L.descend(m, unigram, a[order], b[order], w[order], rng, state, rate=0.02)
    one, two = m.contexts()
    p = np.exp((one[0] + two[1]) @ m.outputs.T + m.bias - m.sums()[1, 0])
    assert p[1] > 0.8


def test_held_out_beats_base(spark):
    got = L.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got)


def test_every_window_is_trained_on():
    """One window makes up nearly all of a text; the rare ones take part too, each with its full count."""
    rng = np.random.default_rng(2)
    ids = [np.zeros(5000, np.int32), *(rng.integers(0, 50, 20).astype(np.int32) for _ in range(40))]
    a, b, w, _ = L.windows(ids, 50)
    got = Counter()
    for x, y, z, n in zip(*(p.tolist() for p in L.examples(a, b, w, 50)), strict=True):
        assert 0 < n <= L.MOST_WEIGHT
        got[x, y, z] += n
    want = Counter(zip(a.tolist(), b.tolist(), w.tolist(), strict=True))
    assert got.keys() == want.keys() and all(math.isclose(got[k], n, rel_tol=1e-4) for k, n in want.items())


def test_weights_scale_gradients():
    """Examples with weights move the model as their repeats do."""
    unigram = np.array([0.4, 0.3, 0.2, 0.1])
    moved = []
    for a, weight in (([0, 0, 0, 1], None), ([0, 1], np.array([3.0, 1.0], np.float32))):
        m = L.start_model(unigram)
        state = {"m1": [np.zeros_like(p) for p in m.parts()], "m2": [np.zeros_like(p) for p in m.parts()], "t": [np.zeros(1)]}
        x = np.array(a)
        L.descend(m, unigram, x, 1 - x, x, np.random.default_rng(3), state, weight=weight)
        moved.append(state["m1"])
    assert all(np.allclose(p, q, atol=1e-6) for p, q in zip(*moved, strict=True))
