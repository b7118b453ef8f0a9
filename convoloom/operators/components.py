"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Rows up to which a list of nodes is broadcast, and the parts into which a node's neighbours are dealt beyond that.
MOST_BROADCAST, SALTS = 1_000_000, 64
#: Edges of a partition, so that small graphs do not pass through many small files.
EDGES_A_PARTITION = 500_000


def _rewire(pairs: DataFrame, parts: int) -> DataFrame:
    """(u, v, m): every listed pair of a node and a neighbour, with the least node around the first.

    The many neighbours of a hub never meet in one task: the least nodes are broadcast if they are few, and joined by node and
    part of its neighbours otherwise."""
    least = materialize(pairs.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts))
    if least.count() <= MOST_BROADCAST:
        return pairs.join(F.broadcast(least), "u")
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = dealt.select("u", "part").distinct().join(least, "u")
    return dealt.join(parts, ["u", "part"]).drop("part")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same nodes as (a, b) do: every node that is not the least of its component, with that one."""
    if not len(a):
        return a, b
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def _contract(edges: DataFrame) -> DataFrame:
    """The edges (u, v) of every partition as stars around the least node of what they join; a partition holds about EDGES_A_PARTITION."""
    schema = edges.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if batches:
            t = pa.Table.from_batches(batches).combine_chunks()
            ends = pa.concat_arrays([c.chunk(0) for c in t.columns])
            ids = pc.unique(ends)
            ids = ids.take(pc.sort_indices(ids))  # places in the order of Spark's comparison
            at = pc.index_in(ends, ids).to_numpy()
            a, b = forest(at[: t.num_rows], at[t.num_rows :])
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(a)), ids.take(pa.array(b))], names=t.column_names)

    return edges.mapInArrow(run, schema)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(id, component) for every node of ``edges``; the component is its least node.

    Partitions of a bounded number of edges are made stars each on its own, so that a round has at most as many edges as a partition
    has nodes; edges of a single partition are settled by that. Each round hangs larger neighbours (large star), then smaller
    ones (small star), on the least node nearby, which takes a number of rounds that grows with the logarithm of the diameter.
    Self-edges keep lone nodes; null ends are left out; repeated edges count once; an empty table gives no rows. The edges of
    every round are cut off through the checkpoint folder; the driver sees only counts.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    ends = materialize(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    # No round adds edges beyond two for each there was.
    parts = max(1, ceil(ends.count() / EDGES_A_PARTITION))
    ends = ends.coalesce(parts)
    nodes = ends.select("u").union(ends.select("v")).distinct()
    state = materialize(_contract(ends.filter(F.col("u") != F.col("v"))))
    mark = state if parts == 1 else None
    for _ in range(max_rounds if parts > 1 else 0):
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: u's larger neighbours go to the least of u and its neighbours.
        large = _rewire(both, parts).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        down = materialize(large.filter(F.col("u") != F.col("v")).coalesce(parts))
        small = _rewire(down, parts)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        state = materialize(small.filter(F.col("u") != F.col("v")).distinct().coalesce(parts))
        # Settled once every node hangs on one root and no root hangs on another.
        sides = state.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(state.select("v", F.lit(0), F.lit(1)))
        open_ = sides.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
        if open_.isEmpty():
            mark = state
            break
    if mark is None:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return nodes.join(mark, "u", "left").select(F.col("u").alias("id"), F.coalesce("v", "u").alias("component"))
