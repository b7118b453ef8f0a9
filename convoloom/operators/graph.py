"""Tool graphs: neighbours, degrees, statistics and bounded clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .components import connected_components

LINE_ROWS = 50_000


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of every edge."""
    cols = ["weight", *[c for c in ("edge_type",) if c in edges.columns]]
    return edges.select("src", "dst", *cols).union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *cols))


def neighbors_topk(edges: DataFrame, k: int) -> DataFrame:
    """Each node's ``k`` heaviest neighbours (ties by id)."""
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("weight"), "dst"))
    return undirected(edges).withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("src").alias("node"), F.col("dst").alias("neighbor"), "weight", "rank")


def degrees(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """The number of neighbours of every node, lone ones included."""
    d = undirected(edges).groupBy("src").agg(F.count("*").alias("degree"))
    return nodes.select(F.col(id_col).alias("node")).join(d, F.col("node") == F.col("src"), "left").select("node", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def components(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """(node, component), the component being its least node; lone nodes are their own."""
    c = connected_components(edges)
    return nodes.select(F.col(id_col).alias("node")).join(c, F.col("node") == F.col("id"), "left").select("node", F.coalesce("component", "node").alias("component"))


def graph_stats(nodes: DataFrame, edges: DataFrame, id_col: str = "id") -> DataFrame:
    """A3 and A4 in one row: nodes, edges, average degree, components, the largest one, density and connectivity (the share of
    nodes in the largest component)."""
    c = components(nodes, edges, id_col).groupBy("component").agg(F.count("*").alias("n")).agg(F.count("*").alias("components"), F.max("n").alias("largest_component"), F.sum("n").alias("nodes"))
    e = edges.agg(F.count("*").alias("edges"))
    n = F.col("nodes").cast("double")
    return c.join(F.broadcast(e)).select(
        F.coalesce("nodes", F.lit(0)).alias("nodes"), "edges", "components", F.coalesce("largest_component", F.lit(0)).alias("largest_component"),
        F.round(F.when(n > 0, 2.0 * F.col("edges") / n).otherwise(0.0), 2).alias("avg_degree"),
        F.round(F.when(n > 1, 2.0 * F.col("edges") / (n * (n - 1))).otherwise(0.0), 4).alias("density"),
        F.round(F.when(n > 0, F.col("largest_component") / n).otherwise(0.0), 4).alias("connectivity"),
    )


def edge_type_counts(edges: DataFrame) -> DataFrame:
    """A4: edges by type and their share in per cent."""
    by = edges.groupBy("edge_type").agg(F.count("*").alias("n"))
    return by.join(F.broadcast(edges.agg(F.count("*").alias("__all")))).select("edge_type", "n", F.round(100.0 * F.col("n") / F.col("__all"), 1).alias("percent"))


def group_edges(nodes: DataFrame, existing: DataFrame, id_col: str, group_col: str, weight: float, edge_type: str, partners: int = 3, seed: int = 7) -> DataFrame:
    """Up to ``partners`` repeatable random partners of the same group for every node; pairs that exist already are left out.

    A group is laid out in the order of a hash and each node takes the next ones, so no pairs of a group are built; groups of
    over ``LINE_ROWS`` nodes are laid out in several lines by another hash.
    """
    rows = nodes.filter(F.col(group_col).isNotNull())
    sizes = rows.groupBy(group_col).agg(F.ceil(F.count("*") / LINE_ROWS).cast("int").alias("__lines"))
    rows = rows.join(sizes, group_col).withColumn("__line", F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.col("__lines")))
    line = Window.partitionBy(group_col, "__line").orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col)).cast("binary")), id_col)
    nexts = F.array(*[F.lead(id_col, i).over(line) for i in range(1, partners + 1)])
    pairs = rows.select(F.col(id_col).alias("a"), nexts.alias("__b")).select("a", F.explode("__b").alias("b")).filter(F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    pairs = pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()
    return pairs.join(existing.select("src", "dst"), ["src", "dst"], "left_anti").select("src", "dst", F.lit(weight).alias("weight"), F.lit(edge_type).alias("edge_type"))


def _adjacency(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(at, near): neighbours as an array of (id, weight) in id order, the first ``most`` only if given."""
    both = undirected(edges)
    if most:
        both = both.withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy("dst"))).filter(F.col("r") <= most)
    return both.groupBy("src").agg(F.array_sort(F.collect_list(F.struct(F.col("dst").alias("id"), "weight"))).alias("near")).select(F.col("src").alias("at"), "near")


def bfs_clusters(starts: DataFrame, edges: DataFrame, max_size: int = 6, id_col: str = "id") -> DataFrame:
    """For each start the first nodes of a breadth-first walk in id order, ``max_size`` at most.

    A node is queued only while cluster and queue together are smaller than that; the queue may hold a node twice. Only the first
    few neighbours of a node can matter, so hubs stay short. A hop brings the neighbours of all queued nodes to their start at
    once and works the queue off in order, so ``max_size`` hops in one plan are enough, however long the walk. Null starts have
    no neighbours, repeated starts count once.
    """
    near = materialize(_adjacency(edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull()), 2 * max_size + 1)).select("at", F.transform("near", lambda x: x["id"]).alias("near"))
    ids = near.schema["near"].dataType.simpleString()
    none = F.array().cast(ids)
    state = starts.select(F.col(id_col).alias("start")).distinct().select("start", F.array("start").alias("queue"), none.alias("cluster"))

    def work(s: Column, item: Column) -> Column:
        rest, grown = F.slice(s["queue"], F.lit(2), F.size(s["queue"])), F.concat(s["cluster"], F.array(item["at"]))
        room = F.greatest(F.lit(max_size) - F.size(grown) - F.size(rest), F.lit(0))
        more = F.slice(F.filter(F.coalesce(item["near"], none), lambda x: ~F.array_contains(grown, x)), F.lit(1), room)
        known = F.exists(s["cluster"], lambda x: x.eqNullSafe(item["at"]))
        pair = lambda queue, cluster: F.struct(queue.alias("queue"), cluster.alias("cluster"))
        return F.when(F.size(s["cluster"]) >= max_size, s).when(known, pair(rest, s["cluster"])).otherwise(pair(F.concat(rest, more), grown))

    for _ in range(max_size):
        each = state.select("start", "queue", "cluster", F.posexplode_outer("queue").alias("pos", "at")).join(near, "at", "left")
        items = F.array_sort(F.collect_list(F.struct("pos", "at", "near")))
        whole = each.groupBy("start").agg(F.first("queue").alias("queue"), F.first("cluster").alias("cluster"), F.filter(items, lambda x: x["pos"].isNotNull()).alias("items"))
        done = F.aggregate("items", F.struct("queue", "cluster"), work)
        state = whole.select("start", done.alias("s")).select("start", "s.queue", "s.cluster")
    return state.select("start", "cluster")
