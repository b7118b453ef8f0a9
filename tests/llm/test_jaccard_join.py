import random
from collections import defaultdict

import pytest

from convoloom.llm import jaccard_join as J

from .helpers import EDGES, edge_docs, empty_docs


def shingles(t):
    w = (t or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(id, class, links, copies) of every row."""
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    texts = list(by)
    sets = [shingles(t) for t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, t in enumerate(texts):
        own = min((i for i in by[t] if i is not None), default=None)
        r = find(k)
        least[r] = own if least.get(r) is None else least[r] if own is None else min(own, least[r])
    return sorted(((str(i), str(least[find(k)]), links[k], len(by[t])) for k, t in enumerate(texts) for i in by[t]))


def check(df, rows):
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links, r.n_copies) for r in J.jaccard_classes(df).collect()) == brute(rows)


def copies(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = " ".join(word() for _ in range(60))
    rows = []
    for _ in range(60):
        base = " ".join(word() for _ in range(rng.randint(3, 150)))
        rows += copies(rng, base, rng.randint(1, 4), 4)
    rows += copies(rng, " ".join(word() for _ in range(100)), 150, 5)
    rows += [passage + " " + " ".join(word() for _ in range(rng.randint(10, 60))) for _ in range(150)]
    rows += ["same text again and again and again"] * 40 + ["a b", "a b", "a  b", "a b c"]
    return list(enumerate(rows))


def test_runs_reach_recall():
    assert J.runs_for() == J.RUNS and J.runs_for(0.9) < J.RUNS


@pytest.mark.parametrize(("small", "bucket", "cluster"), [(64, 8192, 1024), (4, 50, 16)])
def test_brute_force(spark, monkeypatch, small, bucket, cluster):
    monkeypatch.setattr(J, "SMALL", small)
    monkeypatch.setattr(J, "BUCKET_BLOCK", bucket)
    monkeypatch.setattr(J, "CLUSTER_BLOCK", cluster)
    rows = corpus()
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


@pytest.mark.parametrize("stars", [True, False])
def test_blocks_give_fewer_edges_than_members(spark, monkeypatch, stars):
    """Texts of a common passage that half look alike in pairs: a block gives no edge for each pair, nor for each 64 probes."""
    made, plain = [], J._compare_blocks

    def counted(rows):
        out = J.materialize(plain(rows))
        made.append((rows.filter("NOT probe").count(), out.count()))
        return out

    monkeypatch.setattr(J, "_compare_blocks", counted)
    if not stars:
        nothing = lambda *_: spark.createDataFrame([], "src long, dst long")
        monkeypatch.setattr(J, "_first_stars", nothing)
        monkeypatch.setattr(J, "_cluster_stars", nothing)
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = " ".join(word() for _ in range(64))
    rows = list(enumerate(passage + " " + " ".join(word() for _ in range(30)) for _ in range(400)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
    assert made and all(edges <= members for members, edges in made)


def test_shuffled_lists(spark, monkeypatch):
    """Lists over the broadcast bound take the shuffled way."""
    monkeypatch.setattr(J, "MOST_BROADCAST", 0)
    rows = corpus(2)[:120]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_edges(spark):
    check(edge_docs(spark), [(i, t) for i, t, _ in EDGES])
    assert J.jaccard_classes(empty_docs(spark)).count() == 0


def test_representatives(spark):
    rows = [*((i, t, "en") for i, t in corpus(3)[:150]), (1000, "again one two three four", "en"), (1000, "again one two three four", "en"), (None, "again one two three four", "en"), *EDGES]
    docs = edge_docs(spark, rows)
    kept = J.keep_representatives(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    classes = {r[:2] for r in ((x.doc_id, x.class_id) for x in J.jaccard_classes(docs).collect())}
    assert len(got) == len({c for c in _classes_of(rows)})
    assert all((r.doc_id, r.doc_id) in classes for r in got if r.doc_id is not None)
    assert J.keep_representatives(empty_docs(spark)).count() == 0


def _classes_of(rows):
    """A label for the class of every row."""
    by = defaultdict(list)
    for i, t, *_ in rows:
        by[t or ""].append(i)
    texts = list(by)
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    return [find(k) for k in range(len(texts))]
