"""Centroid clustering of integer vectors: Lloyd's rounds with Exponion search, exact at every tie.

Distances are compared as squared integers. Bounds are floating point and carry a margin for rounding, so that a bound only ever
lets more centroids be looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Vectors with a component beyond this are left out, as squared distances would not fit a long.
LARGEST = 1 << 25
#: Relative and absolute allowance for the rounding of bounds.
SLACK = 1e-9
STATE = "vec_id long, v array<int>, cluster int, upper double, lower double"


class Centroids:
    """Centroids with the distances between them, sorted for every one of them."""

    def __init__(self, at: np.ndarray):
        self.at = at.astype(np.int64)
        k = len(self.at)
        gaps = np.sqrt(np.array([((self.at - c) ** 2).sum(1) for c in self.at], float).reshape(k, k))
        np.fill_diagonal(gaps, -1)
        self.order = np.argsort(gaps, axis=1, kind="stable")[:, 1:]
        np.fill_diagonal(gaps, np.inf)
        self.near = gaps.min(1) if k else np.zeros(0)
        self.sorted = np.take_along_axis(gaps, self.order, 1)

    def squared(self, x: np.ndarray, to: np.ndarray | int) -> np.ndarray:
        """Squared distances of rows to a centroid, or to one each."""
        gap = x - self.at[to]
        return np.einsum("ij,ij->i", gap, gap)


def first_search(c: Centroids, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, its distance and the next nearest one's, by looking at all."""
    best, second, who = (np.full(len(x), np.iinfo(np.int64).max) for _ in range(3))
    for j in range(len(c.at)):
        d = c.squared(x, j)
        less = d < best
        second = np.where(less, best, np.minimum(second, d))
        best, who = np.where(less, d, best), np.where(less, j, who)
    return who, np.sqrt(best.astype(float)), np.sqrt(second.astype(float)) if len(c.at) > 1 else np.full(len(x), np.inf)


def next_search(c: Centroids, x: np.ndarray, who: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same from the bounds of the round before; and how many distances it took.

    A vector whose upper bound is below its lower bound, or below half the way from its centroid to the nearest other one, stays.
    Of the rest only centroids in a ball around the vector's own are looked at. What is as far as the radius belongs to it.
    """
    who, upper, lower = who.copy(), upper.copy(), lower.copy()
    safe = np.maximum(lower, c.near[who] / 2) * (1 - SLACK) - SLACK
    left = np.flatnonzero(upper >= safe)
    own = c.squared(x[left], who[left])
    upper[left] = np.sqrt(own.astype(float))
    again = upper[left] >= safe[left]
    left, own, looked = left[again], own[again], len(left)
    began = who[left]
    for a in np.unique(began):
        at = np.flatnonzero(began == a)
        rows, best = left[at], own[at]
        radius = (2 * upper[rows] + c.near[a]) * (1 + SLACK) + SLACK
        inside = np.searchsorted(c.sorted[a], radius, side="right")
        whose, second = np.full(len(rows), a), np.full(len(rows), np.iinfo(np.int64).max)
        for rank in range(inside.max(initial=0)):
            j, some = c.order[a, rank], np.flatnonzero(inside > rank)
            d = c.squared(x[rows[some]], j)
            looked += len(some)
            less = (d < best[some]) | ((d == best[some]) & (j < whose[some]))
            second[some] = np.where(less, best[some], np.minimum(second[some], d))
            best[some], whose[some] = np.where(less, d, best[some]), np.where(less, j, whose[some])
        who[rows], upper[rows] = whose, np.sqrt(best.astype(float))
        lower[rows] = np.where(second < np.iinfo(np.int64).max, np.sqrt(second.astype(float)), np.inf)
    return who, upper, lower, looked


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.int64)


def _round(at: np.ndarray, moved: np.ndarray | None, last: bool):
    """One assignment of batches of the state; the last one has distances in place of vectors and bounds."""
    others = None if moved is None else np.array([np.delete(moved, a).max(initial=0) for a in range(len(moved))])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Centroids(at)
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b, at.shape[1])
            if moved is None:
                who, upper, lower = first_search(c, x)
            else:
                old = _column(b, "cluster")
                upper = (_column(b, "upper") + moved[old]) * (1 + SLACK)
                lower = np.maximum(0, (_column(b, "lower") - others[old]) * (1 - SLACK))
                who, upper, lower, _ = next_search(c, x, old, upper, lower)
            who = pa.array(who, pa.int32())
            if last:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), who, pa.array(c.squared(x, who.to_numpy()))], ["vec_id", "cluster", "distance"])
            else:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), who, pa.array(upper), pa.array(lower)], ["vec_id", "v", "cluster", "upper", "lower"])

    return step


def _whole(v: Column, scale: int) -> Column:
    return F.transform(v, lambda x: F.floor(x.cast("double") * scale))


def kept_vectors(vectors: DataFrame, scale: int = 64, width: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of ``width`` finite components as whole numbers, floor(scale * x); all others are left out."""
    v = F.col(vec_col)
    fits = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) <= LARGEST))
    return vectors.filter((F.size(v) == width) & fits).select(F.col(id_col).alias("vec_id"), _whole(v, scale).cast("array<int>").alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str = "1") -> np.ndarray:
    """The k vectors whose ids have the smallest digests, in that order; equal ids in the order of their components."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r["v"] for r in vectors.orderBy(digest, "v").limit(k).collect()], np.int64)


def _means(state: DataFrame, at: np.ndarray) -> np.ndarray:
    """Centroids moved to the floor of their vectors' means; those without vectors stay."""
    width = at.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(width)])
    at = at.copy()
    for r in sums.collect():
        at[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return at


def cluster_vectors(
    vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64, salt: str = "1", id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors of another length, or with null or non-finite components, are left out, and so are those with a component beyond
    2**25 after scaling, whose distances would not fit a long. Fewer than k vectors give as many centroids; none give no rows.
    Equal vectors share a cluster, and of centroids equally near the smaller number counts. Repeated rows and ids stay, null
    ids too (their digest is that of an empty id); other columns are not looked at.

    The driver holds k centroids of ``width`` numbers and as many sums. Each round is one pass without a shuffle of vectors,
    which carries bounds along in a checkpoint, and a sum by cluster with partial sums in every task, so that a cluster of any
    size is spread over all tasks.
    """
    base = kept_vectors(vectors, scale, width, id_col, vec_col)
    at = first_centroids(base, k, salt)
    answer = "vec_id long, cluster int, distance long"
    if not len(at):
        return base.select(F.col("vec_id").cast("long"), *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]).limit(0)
    state, moved = base.select(F.col("vec_id").cast("long"), "v"), None
    for _ in range(rounds):
        state = materialize(state.mapInArrow(_round(at, moved, False), STATE))
        new = _means(state, at)
        at, moved = new, np.sqrt(((new - at) ** 2).sum(1).astype(float))
    done = materialize(state.mapInArrow(_round(at, moved, True), answer))
    inertia = {r["cluster"]: r["s"] for r in done.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(inertia.values())
    marks = [(a, inertia.get(a, 0), total, hashlib.sha256(",".join(map(str, at[a].tolist())).encode()).hexdigest()) for a in range(len(at))]
    names = state.sparkSession.createDataFrame(marks, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
