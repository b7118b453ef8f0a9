"""Pairs found with bounds are all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from convoloom.operators import pruning, similarity


def clustered(n, centers=30, width=32, noise=0.02, seed=1):
    r = np.random.default_rng(seed)
    c = r.normal(0, 1, (centers, width))
    return c[r.integers(0, centers, n)] + r.normal(0, noise * np.sqrt(width), (n, width)) * 0.5


def brute(v, t, strict=False):
    u = v / np.sqrt((v * v).sum(1))[:, None]
    s = u @ u.T
    x, y = np.nonzero(np.triu(s > t if strict else s >= t, 1))
    return {(int(a), int(b)) for a, b in zip(x, y, strict=True)}


def frame(spark, v, groups=1):
    rows = [(i, f"g{i % groups}", [float(x) for x in w]) for i, w in enumerate(v)]
    return spark.createDataFrame(rows, "id long, g string, v array<double>").repartition(4)


@pytest.mark.parametrize("kind", ["clustered", "random", "copies"])
def test_same_pairs_with_and_without_bounds(spark, monkeypatch, kind):
    r = np.random.default_rng(3)
    v = clustered(700) if kind == "clustered" else r.normal(0, 1, (500, 8)) if kind == "random" else np.repeat(clustered(40), 12, 0)
    t = 0.85 if kind != "random" else 0.6
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 60)
    monkeypatch.setattr(similarity, "SLICE_ROWS", 37)
    got = similarity.similar_pairs(frame(spark, v), t, "id", "id", "v").collect()
    assert {(x["src"], x["dst"]) for x in got} == brute(v, t) and len(got) == len(brute(v, t)) > 100
    u = v / np.sqrt((v * v).sum(1))[:, None]
    assert all(abs(x["similarity"] - u[x["src"]] @ u[x["dst"]]) < 1e-9 for x in got)


def test_groups_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 40)
    v = clustered(300)
    df = frame(spark, v, groups=3).withColumn("v", F.when(F.col("id") % 50 == 0, F.slice("v", 1, 5)).when(F.col("id") == 7, F.array().cast("array<double>")).otherwise(F.col("v")))
    got = {(x["src"], x["dst"]) for x in similarity.similar_pairs(df, 0.85, "id", "id", "v", "g").collect()}
    want = {(a, b) for a, b in brute(v, 0.85) if a % 3 == b % 3 and 7 not in (a, b) and a % 50 and b % 50}
    short = brute(v[::50, :5], 0.85)
    assert got == want | {(50 * a, 50 * b) for a, b in short if (50 * a) % 3 == (50 * b) % 3}


def test_what_bounds_save():
    """Cells of clustered vectors rule each other out, and the first dimensions most pairs; random vectors save nothing."""
    v = clustered(2000)
    g = pruning.geometry(v)
    u = pruning.unit(v)
    may = pruning.candidates(g, u, u, 0.85)
    assert g.first.shape[1] <= 30 and may.mean() < 0.1 and len(g.pivots) >= 25
    assert (may | (u @ u.T < 0.85)).all()
    r = np.random.default_rng(0).normal(0, 1, (2000, 64))
    assert pruning.geometry(r).first is None and pruning.candidates(pruning.geometry(r), r, r, 0.85) is None


def test_cells_that_save_no_copies_are_not_used(spark):
    """Clustered vectors meet few blocks, random ones all blocks of their group, once."""
    for v, saves in ((clustered(900), True), (np.random.default_rng(0).normal(0, 1, (900, 24)), False)):
        rows = frame(spark, v).select(F.lit("").alias("g"), F.size("v").alias("d"), "id", F.col("id").alias("pos"), "v")
        known = {v.shape[1]: pruning.geometry(v)}
        near = pruning.near_cells(pruning.cells_of(rows, known), known, 0.85, 60).collect()
        assert all((x["part"] >= 0) == saves for x in near) and (saves or {x["others"] for x in near} == {15})
