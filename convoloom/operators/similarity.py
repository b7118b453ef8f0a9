"""Cosine joins: every pair at a threshold, by products of blocks."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import usable_embedding
from ..session import materialize
from . import pruning
from .components import connected_components

#: Rows of a block, and of a slice of it that is multiplied at once. A vector is copied once for each block of its group.
BLOCK_ROWS, SLICE_ROWS = 4096, 1024
#: Share of candidates above which a whole product costs less, and pairs that are multiplied at once below it.
DENSE, PAIRS_AT_ONCE = 0.1, 65_536
#: Rounds after which what is left of a graph is looked at as chains, by component and in order, and pairs that one task scans.
ROUNDS_A_LOOK, PAIRS_A_SCAN = 6, 500_000
#: Ranges of positions that are counted to find a component's first pairs; where null positions stand.
RANGES, LAST = 10_000, (1 << 63) - 1


def _most_similar(x: np.ndarray, y: np.ndarray, s: np.ndarray, pos: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``top`` most similar pairs of each x, ties by the position of y."""
    order = np.lexsort((pos[y], -s, x))
    x = x[order]
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, int)
    rank = np.arange(len(x)) - np.repeat(first, np.diff(np.r_[first, len(x)]))
    own = order[rank < top]
    return x[rank < top], y[own], s[own]


def similar_pairs(df: DataFrame, threshold: float, id_col: str, pos_col: str, vec_col: str, group_col: str | None = None, strict: bool = False, top: int | None = None) -> DataFrame:
    """(src, dst, src_pos, dst_pos, similarity) of the pairs, earlier position (then id) first, with cosine ``>= threshold`` (``>``
    if strict); with ``top`` at least the ``top`` most similar for each src (ties by position) and no more a pair of blocks.

    J8 without ``group_col``, J10 with it. The threshold must be positive, so zero, empty and null vectors pair with nothing, nor
    do vectors of different lengths; null groups go; ids have to be distinct. Vectors of a group are dealt to blocks of about
    BLOCK_ROWS and a pair of blocks is one product, so no group meets in one task and every pair is looked at once.

    A group of several blocks is dealt to cells around chosen vectors first, and blocks of cells that are too far apart never meet, where that copies vectors less often than blocks of the whole group do;
    in blocks that meet, the first dimensions after a rotation rule pairs out before the whole product is taken. Both bounds are
    exact. They save most of the work for vectors in clusters and nothing for random ones, whose blocks all meet: there a vector
    is copied as often as its group has blocks.
    """
    if threshold <= 0:
        raise ValueError("the threshold has to be positive")
    vec = F.col(vec_col).cast("array<double>")
    rows = df.filter(usable_embedding(vec)).select(
        (F.col(group_col).cast("string") if group_col else F.lit("")).alias("g"), F.size(vec).alias("d"), F.col(id_col).alias("id"), F.col(pos_col).cast("long").alias("pos"), vec.alias("v")
    )
    if group_col:
        rows = rows.filter(F.col("g").isNotNull())
    id_type = rows.schema["id"].dataType.simpleString()
    sizes = materialize(rows.groupBy("g", "d").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks")))
    big = sizes.filter("blocks > 1")
    known = {} if big.isEmpty() else pruning.sample_of(rows, big)
    if known:
        placed = materialize(pruning.cells_of(rows, known))
        near = materialize(pruning.near_cells(placed, known, threshold, BLOCK_ROWS))
        spread = placed.join(near, ["g", "d", "cell"]).withColumn("cell", F.col("part"))
    else:
        spread = rows.join(sizes, ["g", "d"]).withColumns({"cell": F.lit(0), "other": F.lit(0), "others": F.col("blocks")})
    spread = spread.withColumn("b", F.pmod(F.xxhash64("pos", "id"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    own, met = F.struct(F.col("cell").alias("c"), F.col("b").alias("b")), F.struct(F.col("other").alias("c"), F.col("o").alias("b"))
    spread = spread.select("g", "d", "id", "pos", "v", F.least(own, met).alias("bi"), F.greatest(own, met).alias("bj"), (own <= met).alias("low"))

    def compare(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        _, d, bi, bj = key
        b = b.sort_values(["pos", "id"], kind="stable", ignore_index=True)
        v = np.array(b["v"].tolist(), float)
        length = np.sqrt((v * v).sum(axis=1))
        same = bi == bj
        low = b["low"].to_numpy(bool)
        left, right = (np.arange(len(b)), np.arange(len(b))) if same else (np.flatnonzero(low), np.flatnonzero(~low))
        shape = known.get(int(d))
        u = v / length[:, None] if shape is not None else v
        ids, pos, out = b["id"].to_numpy(), b["pos"].to_numpy(), []
        for at in range(0, len(left), SLICE_ROWS):
            part = left[at : at + SLICE_ROWS]
            may = pruning.candidates(shape, u[part], u[right], threshold)
            if may is None or may.mean() > DENSE:
                sim = (v[part] @ v[right].T) / (length[part][:, None] * length[right][None, :])
                x, y = np.nonzero(sim > threshold if strict else sim >= threshold)
                s = sim[x, y]
            else:
                x, y = np.nonzero(may)
                s = np.concatenate([(v[part[x[k : k + PAIRS_AT_ONCE]]] * v[right[y[k : k + PAIRS_AT_ONCE]]]).sum(axis=1) for k in range(0, len(x), PAIRS_AT_ONCE)] or [np.zeros(0)])
                s = s / (length[part[x]] * length[right[y]])
                keep = s > threshold if strict else s >= threshold
                x, y, s = x[keep], y[keep], s[keep]
            x, y = part[x], right[y]
            if same:
                x, y, s = x[x < y], y[x < y], s[x < y]
            x, y = np.minimum(x, y), np.maximum(x, y)  # rows are in order
            if top is not None:  # a slice keeps no more than its rows need, however many pairs it has
                x, y, s = _most_similar(x, y, s, pos, top)
            out.append((x, y, s))
        x, y, s = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        if top is not None:
            x, y, s = _most_similar(x, y, s, pos, top)
        return pd.DataFrame({"src": ids[x], "dst": ids[y], "src_pos": pos[x], "dst_pos": pos[y], "similarity": s})

    return spread.groupBy("g", "d", "bi", "bj").applyInPandas(compare, f"src {id_type}, dst {id_type}, src_pos long, dst_pos long, similarity double")


def graph_edges(df: DataFrame, threshold: float, top_k: int, id_col: str, pos_col: str, vec_col: str, group_col: str | None = None, edge_type: str = "similarity") -> DataFrame:
    """Pairs at the threshold, at most ``top_k`` for each earlier node, most similar first (ties by position). Each pair of
    blocks sends no more than that on."""
    pairs = similar_pairs(df, threshold, id_col, pos_col, vec_col, group_col, top=top_k)
    order = Window.partitionBy("src").orderBy(F.desc("similarity"), "dst_pos")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_k).select("src", "dst", F.col("similarity").alias("weight"), F.lit(edge_type).alias("edge_type"))


def _scan(own: pd.DataFrame) -> pd.DataFrame:
    """The nodes that go, of pairs read in order."""
    gone: set = set()
    for src, dst in own.sort_values(["src_pos", "src"], kind="stable")[["src", "dst"]].itertuples(index=False):
        if src not in gone:
            gone.add(dst)
    return pd.DataFrame({"dst": list(gone)}, dtype=own["dst"].dtype)


def _without(pairs: DataFrame, gone: DataFrame) -> DataFrame:
    """The pairs of nodes that have not gone."""
    return materialize(pairs.join(gone, "dst", "left_anti").join(gone.withColumnRenamed("dst", "src"), "src", "left_anti").select(*pairs.columns))


def _chains(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that go (dst) on chains, and the pairs that stay open.

    A node with one open earlier neighbour stays if that one goes, and goes if it stays. So it hangs on where its chain of such nodes
    begins, with a sign, which pointers that double their reach find: a number of steps that grows with the logarithm of the
    length. Chains that begin at a node without an earlier neighbour, which stays, are settled at once.
    """
    into = materialize(pairs.groupBy("dst").agg(F.count("*").alias("n"), F.min("src").alias("src")))
    free = pairs.select("src").join(into.select(F.col("dst").alias("src")), "src", "left_anti").distinct()
    hops = materialize(into.filter("n = 1").select(F.col("dst").alias("node"), F.col("src").alias("root"), F.lit(1).alias("odd")))
    steps = 0
    while True:
        on = hops.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("odd").alias("more"))
        hops = materialize(hops.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root"), (F.col("odd") + F.coalesce("more", F.lit(0))).bitwiseAND(1).alias("odd")))
        steps += 1
        if steps % 4 == 0 and hops.join(hops.select(F.col("node").alias("root")), "root", "left_semi").isEmpty():
            break
    settled = materialize(hops.join(free.withColumnRenamed("src", "root"), "root", "left_semi").select("node", "odd"))
    kept = settled.filter("odd = 0").select(F.col("node").alias("src")).union(free)
    gone = settled.filter("odd = 1").select(F.col("node").alias("dst")).union(pairs.join(kept, "src", "left_semi").select("dst")).distinct()
    gone = materialize(gone)
    return gone, _without(pairs, gone)


def _components(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes that go (dst) and the pairs that stay open, after a look at the components. One with up to PAIRS_A_SCAN pairs is read
    in order by a task; of a larger one its earliest pairs are, which settles all nodes up to a position."""
    parts = connected_components(pairs)
    placed = materialize(pairs.join(parts.withColumnRenamed("id", "src"), "src"))
    known = F.when(F.col("dst_pos") < LAST, F.col("dst_pos"))
    sizes = materialize(placed.groupBy("component").agg(F.count("*").alias("n"), F.max("dst_pos").alias("top"), F.min("src_pos").alias("low"), F.max(known).alias("high")))
    small = sizes.filter(F.col("n") <= PAIRS_A_SCAN).select("component", "top")
    width = F.greatest(F.ceil((F.col("high") - F.col("low") + 1) / RANGES), F.lit(1))
    large = sizes.filter(F.col("n") > PAIRS_A_SCAN).select("component", "low", width.alias("width"))
    ranges = placed.filter(known.isNotNull()).join(large, "component").groupBy("component", "low", "width", F.floor((F.col("dst_pos") - F.col("low")) / F.col("width")).alias("range")).agg(F.count("*").alias("m"))
    upto = F.sum("m").over(Window.partitionBy("component").orderBy("range"))
    tops = ranges.withColumn("upto", upto).filter(F.col("upto") <= PAIRS_A_SCAN).groupBy("component").agg(F.max(F.col("low") + (F.col("range") + 1) * F.col("width") - 1).alias("top"))
    tops = materialize(small.union(tops))
    kind = pairs.schema["dst"].dataType.simpleString()
    marked = placed.join(tops, "component", "left")
    gone = materialize(marked.filter("dst_pos <= top").groupBy("component").applyInPandas(_scan, f"dst {kind}"))
    later = marked.filter("dst_pos > top or top is null")
    hit = later.filter("src_pos <= top").join(gone.withColumnRenamed("dst", "src"), "src", "left_anti").select("dst")
    gone = materialize(gone.union(hit).distinct())
    return gone, _without(later.filter("src_pos > top or top is null").select(*pairs.columns), gone)


def settled(pairs: DataFrame) -> DataFrame:
    """The nodes (dst) that go in the greedy independent set of pairs (src, dst, src_pos, dst_pos), each once, src being earlier."""
    open_pairs, removed, rounds, looks = pairs, [], 0, 0
    while not open_pairs.isEmpty():
        rounds += 1
        if rounds >= ROUNDS_A_LOOK and (rounds - ROUNDS_A_LOOK) % 2 == 0:
            gone, open_pairs = (_chains, _components)[looks % 2](open_pairs)
            looks += 1
        else:
            blocked = open_pairs.select(F.col("dst").alias("src")).distinct()
            lead = open_pairs.join(blocked, "src", "left_anti").select("src").distinct()
            gone = materialize(open_pairs.join(lead, "src", "left_semi").select("dst").distinct())
            open_pairs = _without(open_pairs, gone)
        removed.append(gone)
    return reduce(DataFrame.union, removed) if removed else pairs.select("dst").limit(0)


def leader_clusters(df: DataFrame, threshold: float, id_col: str, pos_col: str, vec_col: str, group_col: str) -> DataFrame:
    """(id, group, leader, kept, usable). In input order an item that no earlier leader of its group resembles leads; the others join
    the earliest leader that they resemble. Items without a usable embedding are kept and lead nobody.

    That is the greedy independent set of the similarity graph, settled in rounds: items whose earlier neighbours are all
    decided lead, what resembles them is removed. Now and then what is left is looked at in other ways: chains of items with one
    undecided neighbour each are settled by pointers, components are read in order, each by a task if it has few pairs, and of
    larger ones as many of the first pairs as a task may read. Groups of any size are spread, and the driver sees no rows. Ids
    have to be distinct; items with a null position come last.
    """
    group = F.coalesce(F.col(group_col).cast("string"), F.lit("no_scenario"))
    base = df.withColumn("__g", group)
    found = similar_pairs(base, threshold, id_col, pos_col, vec_col, "__g")
    pairs = materialize(found.select("src", "dst", *[F.coalesce(c, F.lit(LAST)).alias(c) for c in ("src_pos", "dst_pos")]))
    removed = settled(pairs)
    led = pairs.join(removed.withColumnRenamed("dst", "src"), "src", "left_anti").join(removed, "dst", "left_semi")
    leaders = led.groupBy("dst").agg(F.min(F.struct("src_pos", "src")).alias("m")).select(F.col("dst").alias("__id"), F.col("m.src").alias("__leader"))
    out = base.select(F.col(id_col).alias("id"), F.col("__g").alias("group"), usable_embedding(vec_col).alias("usable")).join(leaders, F.col("id") == F.col("__id"), "left")
    return out.select("id", "group", F.when(F.col("usable"), F.coalesce("__leader", "id")).alias("leader"), F.col("__leader").isNull().alias("kept"), "usable")


def dedup_stats(clusters: DataFrame) -> DataFrame:
    """For each group its items, those kept and removed, and its clusters; a group with fewer than two usable items was not
    clustered and has 0."""
    usable = F.count_if("usable")
    return clusters.groupBy("group").agg(
        F.count("*").alias("original"), F.count_if("kept").alias("final"), F.count_if(~F.col("kept")).alias("removed"),
        F.when(usable < 2, F.lit(0)).otherwise(F.count_if(F.col("usable") & F.col("kept"))).cast("long").alias("clusters"),
    )
