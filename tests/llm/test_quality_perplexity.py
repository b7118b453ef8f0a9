from collections import Counter
from math import exp, log

import numpy as np
import pytest

from convoloom.llm import quality_perplexity as K

from .helpers import EDGES, edge_docs, empty_docs


def sequence(t):
    raw = t.replace("\0", "\1").encode("utf-16-le", "surrogatepass")
    return [0] * (K.ORDER - 1) + [raw[i] | raw[i + 1] << 8 for i in range(0, len(raw), 2)] + [0]


def windows(t):
    s = sequence(t)
    return [tuple(s[i - K.ORDER + 1 : i + 1]) for i in range(K.ORDER - 1, len(s))]


def packed(gram):
    key = 0
    for u in gram:
        key = key << K.BITS | u
    return key - (1 << 64) if key >= 1 << 63 else key


def brute(texts):
    """Interpolated modified Kneser-Ney from dictionaries of n-grams."""
    levels = [Counter(g for t in texts for g in windows(t))]
    while len(next(iter(levels[-1]))) > 1:
        levels.append(Counter(g[1:] for g in levels[-1]))
    cuts, own = [], []
    for c in levels:
        n = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
        cuts.append([0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] else 0.0 for k in (1, 2, 3))])
        by = {}
        for g, v in c.items():
            by.setdefault(g[:-1], []).append(v)
        own.append(by)

    def p(gram, level=0):
        lower = 1 / 65536 if len(gram) == 1 else p(gram[1:], level + 1)
        seen, d = own[level].get(gram[:-1]), cuts[level]
        if not seen:
            return lower
        spare = sum(d[min(v, 3)] for v in seen)
        mass = spare if spare > 0 else 0.5
        v = levels[level].get(gram, 0)
        return (v - d[min(v, 3)] + mass * lower) / (sum(seen) - spare + mass)

    return p


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


def test_counts_and_probabilities(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a cat, a mat!", "", "The END\n\n12", "日本語 😀 ÿ\0"] * 3
    counts = K.count_grams(frame(spark, texts).repartition(3))
    assert {r.gram: r.n for r in counts.collect()} == Counter(packed(g) for t in texts for g in windows(t))
    p = brute(texts)
    asked = {g for t in ("the cat", "a zebra!", "", "日語 😀", "￿￾�x") for g in windows(t)}
    needed = spark.createDataFrame([(packed(g),) for g in asked], "gram long")
    got = {r.gram: r.logp for r in K.gram_logs(counts, needed).collect()}
    assert len(got) == len(asked)
    assert all(abs(got[packed(g)] - log(p(g))) < 1e-9 for g in asked)


def test_probabilities_are_normalised(spark):
    counts = K.count_grams(frame(spark, ["one two\nthree", "a b", "one ton"]))
    for context in ((0, 0, 0), (111, 110, 101), (7, 7, 7)):
        needed = spark.createDataFrame([(packed((*context, u)),) for u in range(65536)], "gram long")
        assert abs(sum(exp(r.logp) for r in K.gram_logs(counts, needed).collect()) - 1) < 1e-6


def _held_back(doc_id):
    from zlib import crc32

    return crc32(str(doc_id).encode()) % K.HELD_OUT == 0


def test_perplexities_and_thresholds(spark):
    """Against dictionaries and sorted lists, over other layouts too; a cut of several units is among the texts."""
    rng = np.random.default_rng(5)
    words = {"a": ["red", "green", "blue", "sky"], "b": ["eins", "zwei", "drei"]}
    rows = [(i, " ".join(rng.choice(words[lang], 3 + i % 9)), lang) for i, lang in enumerate("ab" * 60)]
    rows += [(500, "qz$$ " * 9, "a"), (501, "qz", "c"), (502, None, "b"), (503, "red sky", None)]
    labels = [(i, 1, int(i % 40 == 7)) for i in range(100)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    trusted = {i for i, _, toxic in labels if not toxic}
    p = brute([t for i, t, _ in rows if i in trusted and not _held_back(i)])
    cost = {i: (len(windows(t or "")), sum(log(p(g)) for g in windows(t or ""))) for i, t, _ in rows}
    lang = {i: x or "" for i, _, x in rows}
    mean = lambda ids: sum(cost[i][1] for i in ids) / sum(cost[i][0] for i in ids)
    loss = {}
    for i in cost:
        same = [j for j in trusted if lang[j] == lang[i]] or trusted
        loss[i] = -(cost[i][1] + K.PRIOR_CHARS * mean(same)) / (cost[i][0] + K.PRIOR_CHARS)
    rank = lambda values, q: sorted(values)[max(0, int(np.ceil(q * len(values))) - 1)]
    fresh = {x: [loss[j] for j in trusted if _held_back(j) and lang[j] == x] for x in ("a", "b")}
    middle = {x: rank(v, 0.5) for x, v in fresh.items()}
    pooled = rank([v - middle[x] for x, own in fresh.items() for v in own], K.QUANTILE)
    limit = dict.fromkeys(("c", ""), rank([v for own in fresh.values() for v in own], K.QUANTILE))
    for x, own in fresh.items():
        reach = rank(own, K.QUANTILE) - middle[x]
        limit[x] = middle[x] + (len(own) * reach + K.PRIOR_ROWS * max(reach, pooled)) / (len(own) + K.PRIOR_ROWS)
    for parts in (1, 5):
        got = K.classify(edge_docs(spark, rows).repartition(parts), marks).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.n_chars == cost[r.doc_id][0] - 1
            assert abs(r.log10_probability - cost[r.doc_id][1] / log(10)) < 1e-6
            assert abs(log(r.perplexity) - loss[r.doc_id]) < 1e-6 and abs(log(r.threshold) - limit[lang[r.doc_id]]) < 1e-6
            assert r.kept == (log(r.perplexity) <= log(r.threshold) + 1e-9)


def test_many_units_and_many_languages(spark, monkeypatch):
    rows = [(i, f"plain words {i} " * 24_000, f"l{i % 7}") for i in range(40)] + [(i, f"plain words {i} " * 24_000, "l0") for i in range(3)]
    docs = edge_docs(spark, rows).coalesce(1)
    marks = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert K.unit_grams(docs.select("doc_id", "lang", "text")).count() > 1
    found = []
    for most in (K.MOST_LANGUAGES_BROADCAST, 0):
        monkeypatch.setattr(K, "MOST_LANGUAGES_BROADCAST", most)
        monkeypatch.setattr(K, "MOST_IDS_BROADCAST", most)
        got = K.classify(docs, marks).collect()
        found.append(sorted((r.doc_id, r.lang, round(r.log10_probability, 3), round(r.threshold, 9), r.kept) for r in got))
        assert K.keep_good(docs, marks).count() == sum(r.kept for r in got)
    assert found[0] == found[1] and len(found[0]) == 43


def test_another_partitioning_is_an_error(spark):
    """A second reading that gives other units is noticed."""
    docs = edge_docs(spark, [(1, "some words", "en"), (2, "other words", "en")]).withColumn("text", K.F.concat("text", K.F.expr("reflect('java.util.UUID', 'randomUUID')")))
    with pytest.raises(Exception, match="other partitions"):
        K.score(docs, K.count_grams(docs.select("text"))).collect()


def _trained(spark):
    good = [(100 + i, f"a plain sentence about the number {i % 17} and the colour of the sky, which is blue.", "en") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(60)] + [(None, 1, 0), (4, None, None), (100, 1, None)], "doc_id long, quality int, toxic int")
    return good, labels


def test_edges(spark):
    good, labels = _trained(spark)
    junk = [(900, "QZ$$ XK%% WJ&& " * 30, "en"), (901, "QZ$$ XK%% WJ&& " * 30, "xx")]
    docs = edge_docs(spark, [*EDGES, *good, *junk])
    got = K.classify(docs, labels).collect()
    assert len(got) == len(EDGES) + 62
    kept = {r.doc_id: r.kept for r in got}
    assert sum(kept[100 + i] for i in range(60)) >= 54 and not kept[900] and not kept[901]
    out = K.keep_good(docs, labels)
    assert out.columns == docs.columns and out.count() == sum(r.kept for r in got)
    assert K.classify(empty_docs(spark), labels).count() == 0 and K.keep_good(empty_docs(spark), labels).count() == 0
    free = K.classify(docs, labels.limit(0)).collect()
    assert len(free) == len(got) and all(r.kept for r in free)


def test_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = K.classify(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1 and toxic = 0"), "doc_id").collect()
    clean, bad = [r.kept for r in got if r.quality == 1], [r.kept for r in got if r.quality == 0]
    assert sum(clean) / len(clean) >= 0.95 and sum(bad) / len(bad) <= 0.2


def test_other_scripts_are_told_apart(spark):
    """A scramble of letters with the same word lengths scores below the text in any script."""
    rng = np.random.default_rng(4)
    words = {"ru": "простой рассказ о том как море было синим и небо тоже".split(), "el": "μια απλη ιστορια για τη θαλασσα και τον ουρανο".split(), "zh": "這是 一個 簡單 的故事 關於 大海 和 天空".split()}
    line = lambda lang: " ".join(rng.choice(words[lang], 30))
    docs, labels = [], []
    for lang in words:
        for _ in range(30):
            docs.append((len(docs), line(lang), lang))
            labels.append((len(labels), 1, 0))
    pairs = []
    for lang in words:
        good = docs[[d[2] for d in docs].index(lang)][1]
        letters = list(rng.permutation([c for c in good if c != " "]))
        pairs.append((good, "".join(c if c == " " else letters.pop() for c in good)))
        docs += [(1000 + len(docs) + k, t, lang) for k, t in enumerate(pairs[-1])]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id, r.log10_probability, r.kept) for r in K.classify(edge_docs(spark, docs), marks).collect())
    assert len(got) == len(docs)
    for a, b in zip(got[90::2], got[91::2], strict=True):
        assert not b[2] and a[1] > b[1] + 20
