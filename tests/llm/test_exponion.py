import hashlib
import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm import exponion as X


def brute(rows, k=16, rounds=3, scale=64, width=64):
    """Plain Lloyd rounds in Python's whole numbers."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            w = [math.floor(scale * x) for x in v]
            if max(map(abs, w)) <= X.LARGEST:
                kept.append((i, w))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    at = [w for _, w in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(w, c, strict=True)), j) for j, c in enumerate(at)) for _, w in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(at)):
            own = [w for (_, w), (_, a) in zip(kept, of, strict=True) if a == j]
            if own:
                at[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    of = assign()
    sums = {j: sum(d for d, a in of if a == j) for j in range(len(at))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted(((i, j, d, sums[j], sum(sums.values()), digests[j]) for (i, _), (d, j) in zip(kept, of, strict=True)), key=str)


def table(spark, rows, extra=("v", "cluster", "upper", "lower", "distance", "inertia")):
    schema = "vec_id long, embedding array<float>, " + ", ".join(f"`{c}` string" for c in extra)
    return spark.createDataFrame([(i, v) + ("x",) * len(extra) for i, v in rows], schema)


def run(spark, rows, **how):
    return sorted((tuple(r) for r in X.cluster_vectors(table(spark, rows), **how).collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.integers(1, 3), st.integers(1, 6))
def test_bounds_never_change_the_nearest(seed, k, width, span):
    """Small whole numbers give ties and equal centroids in plenty."""
    r = np.random.default_rng(seed)
    x = r.integers(-span, span + 1, (60, width))
    at = r.integers(-span, span + 1, (k, width))
    who, upper, lower = X.first_search(X.Centroids(at), x)
    for _ in range(4):
        new = at + r.integers(-1, 2, at.shape)
        moved = np.sqrt(((new - at) ** 2).sum(1).astype(float))
        others = np.array([np.delete(moved, a).max(initial=0) for a in range(k)])
        at = new
        who, upper, lower, _ = X.next_search(X.Centroids(at), x, who, upper + moved[who], np.maximum(0, lower - others[who]))
        d = ((x[:, None] - at[None]) ** 2).sum(2)
        assert (who == d.argmin(1)).all()
        assert (upper >= np.sqrt(d.min(1)) - 1e-6).all()
        if k > 1:
            assert (lower <= np.sqrt(np.sort(d, 1)[:, 1]) + 1e-6).all()


def test_search_saves_distances():
    r = np.random.default_rng(1)
    at = r.integers(-1000, 1000, (16, 8))
    x = np.repeat(at, 200, 0) + r.integers(-20, 21, (3200, 8))
    who, upper, lower = X.first_search(X.Centroids(at), x)
    at2 = at + 1
    moved = np.full(16, np.sqrt(8))
    *_, looked = X.next_search(X.Centroids(at2), x, who, upper + moved[who], lower - moved[who])
    assert looked < 0.2 * x.shape[0] * 16


def test_equals_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(0, 1, 64)]) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_odd_vectors(spark):
    """Few whole values, many equal vectors and ids, and vectors that are left out."""
    r = np.random.default_rng(6)
    rows = [(i // 2, [float(x) for x in r.integers(-1, 2, 64) / 64]) for i in range(120)] + [(i, [0.5] * 64) for i in range(1000, 1100)]
    rows += [(None, [0.25] * 64), (None, [0.25] * 64), (1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 63 + [None]), (5, [1.0] * 63 + [math.nan])]
    rows += [(6, [math.inf] * 64), (7, [1e30] * 64), (8, [1.0] * 65)]
    assert run(spark, rows) == brute(rows)


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(5)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == brute(rows[:1])
    assert run(spark, []) == [] and run(spark, [(1, [1.0])]) == []
    assert X.cluster_vectors(table(spark, [])).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_other_parameters(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(0, 1, 3)]) for i in range(80)]
    assert run(spark, rows, k=5, rounds=6, scale=10, width=3) == brute(rows, 5, 6, 10, 3)
