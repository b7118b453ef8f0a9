"""Queries over embeddings as tools: id and position ``vec_id``, scenario ``label``. Thresholds fit these vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors
from ..functions.text import uniform
from ..operators import graph, joins, records, sampling, similarity, stats, walks
from ..session import materialize
from .registry import query, table

PAIR, EDGE, TOP, LEADER = 0.4, 0.2, 2, 0.25
E = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
GRAPH = f"""{E}, pairs AS (SELECT a.vec_id AS src, b.vec_id AS dst, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id),
g AS (SELECT src, dst, s AS weight FROM pairs WHERE s >= {EDGE} QUALIFY row_number() OVER (PARTITION BY src ORDER BY s DESC, dst) <= {TOP}),
u AS (SELECT src, dst, weight FROM g UNION ALL SELECT dst, src, weight FROM g)"""
COMPONENTS = GRAPH + """, walk(node, reached) AS (SELECT vec_id, vec_id FROM e UNION SELECT w.node, u.dst FROM walk w JOIN u ON w.reached = u.src),
c AS (SELECT node, min(reached) AS component FROM walk GROUP BY node)"""


def _tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.graph_edges(_tools(spark, sf_dir), EDGE, TOP, "vec_id", "vec_id", "embedding", "label")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tools(spark, sf_dir).select(F.col("vec_id").alias("id"), "label")


@query(f"WITH {E} SELECT a.vec_id AS src, b.vec_id AS dst, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) > {PAIR}")
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8, C3."""
    return similarity.similar_pairs(_tools(spark, sf_dir), PAIR, "vec_id", "vec_id", "embedding", strict=True).select("src", "dst", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {GRAPH} SELECT src, dst, round(weight, 6) AS weight FROM g")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, J10, G1, C1, L1."""
    return _edges(spark, sf_dir).select("src", "dst", F.round("weight", 6).alias("weight"))


LEADERS = f"""WITH RECURSIVE {E}, o AS (SELECT vec_id, label, v, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM e),
l AS (SELECT label, CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(id BIGINT, v DOUBLE[])[]) AS leaders, CAST(NULL AS BIGINT) AS id, CAST(NULL AS BIGINT) AS leader FROM (SELECT DISTINCT label FROM o)
  UNION ALL
  SELECT o.label, o.i, CASE WHEN len(list_filter(l.leaders, lambda x: list_cosine_similarity(x.v, o.v) >= {LEADER})) = 0 THEN list_append(l.leaders, {{'id': o.vec_id, 'v': o.v}}) ELSE l.leaders END, o.vec_id,
    coalesce(list_filter(l.leaders, lambda x: list_cosine_similarity(x.v, o.v) >= {LEADER})[1].id, o.vec_id)
  FROM l JOIN o ON o.label = l.label AND o.i = l.i + 1),
d AS (SELECT id, CAST(label AS VARCHAR) AS "group", leader, leader = id AS kept FROM l WHERE id IS NOT NULL)"""


@query(LEADERS + ' SELECT id, "group", leader, kept FROM d')
def leader_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1, D2, C2."""
    return similarity.leader_clusters(_tools(spark, sf_dir), LEADER, "vec_id", "vec_id", "embedding", "label").drop("usable")


@query(LEADERS + ' SELECT "group", count(*) AS original, count(*) FILTER (kept) AS final, count(*) FILTER (NOT kept) AS removed, count(*) FILTER (kept) AS clusters FROM d GROUP BY "group"')
def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11."""
    return similarity.dedup_stats(similarity.leader_clusters(_tools(spark, sf_dir), LEADER, "vec_id", "vec_id", "embedding", "label"))


@query("WITH RECURSIVE " + COMPONENTS + " SELECT node, component FROM c")
def graph_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4."""
    return graph.components(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query(
    "WITH RECURSIVE " + COMPONENTS + """, k AS (SELECT component, count(*) AS n FROM c GROUP BY component), m AS (SELECT CAST(sum(n) AS BIGINT) AS nodes, count(*) AS components, max(n) AS largest_component, (SELECT count(*) FROM g) AS edges FROM k)
  SELECT nodes, edges, components, largest_component, round(2.0 * edges / nodes, 2)::DOUBLE AS avg_degree, round(2.0 * edges / (nodes * (nodes - 1)), 4)::DOUBLE AS density, round(largest_component * 1.0 / nodes, 4)::DOUBLE AS connectivity FROM m"""
)
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4."""
    return graph.graph_stats(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query(f"WITH {GRAPH} SELECT src AS node, dst AS neighbor, round(weight, 6) AS weight, CAST(row_number() OVER (PARTITION BY src ORDER BY weight DESC, dst) AS INTEGER) AS rank FROM u QUALIFY rank <= 3")
def neighbors_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2."""
    return graph.neighbors_topk(_edges(spark, sf_dir), 3).withColumn("weight", F.round("weight", 6))


@query(f"WITH {GRAPH} SELECT vec_id AS node, (SELECT count(*) FROM u WHERE u.src = e.vec_id) AS degree FROM e")
def node_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G9."""
    return graph.degrees(_nodes(spark, sf_dir), _edges(spark, sf_dir))


@query(f"WITH {GRAPH} SELECT 'similarity' AS edge_type, count(*) AS n, 100.0::DOUBLE AS percent FROM g HAVING count(*) > 0")
def edge_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4."""
    return graph.edge_type_counts(_edges(spark, sf_dir))


@query("SELECT count(*) AS total, count(*) FILTER (len(embedding) > 0) AS present, round(100.0 * count(*) FILTER (len(embedding) > 0) / count(*), 2)::DOUBLE AS coverage FROM embeddings")
def embedding_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8, F11."""
    return stats.coverage(_tools(spark, sf_dir), vectors.has_embedding("embedding"))


@query(
    """WITH e AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(b.embedding AS DOUBLE[]) AS y FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
  SELECT vec_id, round(list_cosine_similarity(x, y), 6) AS plain, round(list_cosine_similarity(x, y), 6) AS graph, round(greatest(0, list_cosine_similarity(x, y)), 6) AS clamped, true AS usable FROM e"""
)
def cosine_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1, C2, C3, F11b on neighbouring ids."""
    a = _tools(spark, sf_dir).select("vec_id", F.col("embedding").alias("x"))
    b = _tools(spark, sf_dir).select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("y"))
    j = a.join(b, "vec_id")
    return j.select("vec_id", F.round(vectors.cosine_plain("x", "y"), 6).alias("plain"), F.round(vectors.cosine_graph("x", "y"), 6).alias("graph"), F.round(vectors.cosine_clamped("x", "y"), 6).alias("clamped"), vectors.usable_embedding("x").alias("usable"))


@query(
    "WITH RECURSIVE " + GRAPH + """, near AS (SELECT src AS at, list(dst ORDER BY dst) AS near FROM u GROUP BY src),
b AS (SELECT vec_id AS start, 0 AS i, [vec_id] AS queue, CAST([] AS BIGINT[]) AS cluster FROM e
  UNION ALL
  SELECT start, i + 1, CASE WHEN list_contains(cluster, queue[1]) THEN queue[2:]
    ELSE list_concat(queue[2:], list_filter(coalesce(near, []), lambda x: NOT list_contains(list_append(cluster, queue[1]), x))[1:greatest(0, 6 - len(cluster) - 1 - len(queue[2:]))]) END,
    CASE WHEN list_contains(cluster, queue[1]) THEN cluster ELSE list_append(cluster, queue[1]) END
  FROM b LEFT JOIN near ON near.at = b.queue[1] WHERE len(queue) > 0 AND len(cluster) < 6)
SELECT start, arg_max(cluster, i) AS cluster FROM b GROUP BY start"""
)
def bfs_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 from every node."""
    return graph.bfs_clusters(_nodes(spark, sf_dir), _edges(spark, sf_dir), 6)


@query()
def random_walk_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One walk from every node, topped up from its neighbours; combinations of three tools or more, each once."""
    nodes, edges = _nodes(spark, sf_dir), _edges(spark, sf_dir)
    size = F.floor(uniform(F.lit(7), F.col("walk"), F.lit("size")) * 4).cast("int") + 2
    made = walks.related_tools(walks.random_walks(nodes.withColumn("walk", F.col("id")), edges, size, node_col="id"), edges, 5)
    combos = made.select("walk", F.concat(F.array("start"), "nodes").cast("array<string>").alias("tools")).filter(F.size("tools") >= 3)
    named = combos.join(nodes.select(F.col("id").alias("walk"), F.col("label").cast("string").alias("label")), "walk")
    record = named.select("walk", records.combination_record(F.col("label"), F.col("tools"), F.lit("random_walk")).alias("r")).select("walk", "r.*")
    return joins.dedup_combinations(record, "tool_ids", "walk").select("id", "scenario_id", F.array_join("tool_ids", ",").alias("tool_ids"), "generation_method", "tool_count")


@query()
def scenario_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An even quota of combinations of three to six tools for every scenario, one for each tool there is."""
    nodes = materialize(_nodes(spark, sf_dir))
    made = walks.scenario_combinations(nodes, materialize(_edges(spark, sf_dir)), nodes.count(), scenario_col="label")
    record = records.combination_record(F.col("scenario").cast("string"), F.col("tools").cast("array<string>"), F.lit("random_walk"))
    return made.select("number", "start", record.alias("r")).select("number", "start", "r.*").withColumn("tool_ids", F.array_join("tool_ids", ","))


@query(
    f"""WITH {GRAPH}, n AS (SELECT vec_id AS a, unnest([lead(vec_id, 1) OVER w, lead(vec_id, 2) OVER w, lead(vec_id, 3) OVER w]) AS b FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY md5('7:' || vec_id), vec_id))
  SELECT DISTINCT least(a, b) AS src, greatest(a, b) AS dst, 0.6::DOUBLE AS weight, 'category' AS edge_type FROM n WHERE b IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g WHERE g.src = least(a, b) AND g.dst = greatest(a, b))"""
)
def category_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13."""
    return graph.group_edges(_nodes(spark, sf_dir), _edges(spark, sf_dir), "id", "label", 0.6, "category")


@query(
    "WITH " + GRAPH + """, n AS (SELECT label, count(*) AS n FROM e GROUP BY label),
d AS (SELECT label, count(*) AS edges FROM g JOIN e ON vec_id = src GROUP BY label),
w AS (SELECT label, n * 0.7 + coalesce(edges, 0) / n * 0.3 AS w FROM n LEFT JOIN d USING (label)),
s AS (SELECT label, 997 * (w::DOUBLE / sum(w::DOUBLE) OVER ()) AS share FROM w),
f AS (SELECT *, floor(share) AS whole FROM s)
SELECT label AS "group", CAST(whole + CASE WHEN row_number() OVER (ORDER BY share - whole DESC, label) <= 997 - sum(whole) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM f"""
)
def proportional_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """997 combinations shared out among scenarios by their tools and edges."""
    nodes = _nodes(spark, sf_dir)
    edges = _edges(spark, sf_dir).join(nodes.withColumnRenamed("id", "src"), "src").groupBy("label").agg(F.count("*").alias("edges"))
    sizes = nodes.groupBy("label").agg(F.count("*").alias("n")).join(edges, "label", "left")
    return sampling.apportion(sizes, 997, "label", F.col("n") * 0.7 + F.coalesce("edges", F.lit(0)) / F.col("n") * 0.3)
