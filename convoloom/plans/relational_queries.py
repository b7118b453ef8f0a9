"""Queries over the star-schema tables as scenarios, tools, agents and tasks.

part: tools (p_partkey, p_name); customer: agents; orders: tasks; lineitem: the tools of a task; events: an execution log;
documents: scenarios; labels: evaluations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import entities, filters, joins, records, sampling, stats
from ..schemas import DIFFICULTIES
from .registry import query, table

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "9-UNUSED")
UNIFORM = "(('0x' || substr(md5('7:' || {key}), 1, 13))::BIGINT / 4503599627370496.0)"


def _score() -> Column:
    return F.col("p_size") / 10.0


def _evals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations, some of which come a second time, further back."""
    one = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") * 2.0 + 2.5 + F.col("toxic") * 0.5 * F.col("quality")).alias("overall_score"), F.lit(0).alias("pos"))
    return one.unionByName(one.filter("id % 5 = 0").withColumns({"overall_score": 7.0 - F.col("overall_score"), "pos": F.lit(1)}))


EVALS = """one AS (SELECT doc_id AS id, quality * 2.0 + 2.5 + toxic * 0.5 * quality AS s, 0 AS pos FROM labels), ev AS (SELECT id, arg_max(s, pos) AS overall_score
  FROM (SELECT * FROM one UNION ALL SELECT id, 7.0 - s, 1 FROM one WHERE id % 5 = 0) GROUP BY id)"""


@query(f"WITH {EVALS} SELECT d.doc_id AS id, round(e.overall_score, 2)::DOUBLE AS score FROM documents d LEFT JOIN ev e ON d.doc_id = e.id WHERE e.overall_score IS NULL OR e.overall_score >= 4.0")
def quality_filter_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, J4."""
    tools = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return filters.filter_tools_by_score(tools, _evals(spark, sf_dir), 4.0, pos_col="pos").select("id", F.round("score", 2).alias("score"))


@query(
    f"""WITH {EVALS} SELECT count(*) AS total, count(e.overall_score) AS evaluated, count(*) FILTER (e.overall_score >= 4.0) AS high_quality, count(*) FILTER (e.overall_score < 4.0) AS filtered,
  count(*) FILTER (e.overall_score IS NULL) AS no_evaluation FROM documents d LEFT JOIN ev e ON d.doc_id = e.id"""
)
def quality_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 counters."""
    return filters.tool_filter_counts(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), _evals(spark, sf_dir), pos_col="pos")


@query(f"WITH {EVALS} SELECT d.doc_id AS id, coalesce(e.overall_score, 3.0)::DOUBLE AS overall_score, e.overall_score IS NULL AS failed FROM documents d LEFT JOIN ev e ON d.doc_id = e.id")
def evaluation_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14, M6."""
    return stats.merge_evaluations(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), _evals(spark, sf_dir), pos_col="pos")


@query("SELECT p_partkey AS id FROM part WHERE p_size / 10.0 > 4.0")
def quality_filter_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2."""
    return table(spark, sf_dir, "part").filter(filters.strict_score(_score(), 4.0)).select(F.col("p_partkey").alias("id"))


@query("SELECT p_partkey AS id FROM part WHERE coalesce(CASE WHEN p_size % 7 <> 0 THEN p_size / 10.0 END, 5.0) >= 3.0")
def quality_filter_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3."""
    return table(spark, sf_dir, "part").filter(filters.default_score(F.when(F.col("p_size") % 7 != 0, _score()))).select(F.col("p_partkey").alias("id"))


@query("SELECT p_partkey AS id, p_size / 10.0 >= 4.0 AS passed, p_size / 10.0 - 1 BETWEEN 0 AND 3 AS valid FROM part")
def score_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U6, F9."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), filters.passed(_score()).alias("passed"), filters.valid_score(_score() - 1, 0.0, 3.0).alias("valid"))


@query("SELECT doc_id AS id, coalesce(length(source) > 0 AND length(text) > 0 AND length(lang) > 0 AND length(text) >= 10, false) AS valid FROM documents")
def validate_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), filters.valid_scenario(F.col("source"), F.col("text"), F.col("lang")).alias("valid"))


PARAMS_JSON = """CASE p_partkey % 5 WHEN 0 THEN '[{"name":"a","type":"string","description":""}]' WHEN 1 THEN '[{"name":"a","type":"string"}]' WHEN 2 THEN '{"name":"a"}' WHEN 3 THEN '[]' END"""


@query("SELECT p_partkey AS id, p_partkey % 5 IN (0, 3, 4) AS valid FROM part")
def validate_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), filters.valid_tool(F.col("p_name"), F.col("p_type"), F.expr(PARAMS_JSON)).alias("valid"))


@query("SELECT o_orderkey AS id, o_orderkey % 4 <> 3 AND o_orderkey % 6 <> 5 AS valid, CASE WHEN o_orderkey % 6 = 5 THEN '' WHEN o_orderkey % 4 = 3 THEN 'search,wipe' ELSE 'search,search' END AS expected FROM orders")
def validate_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, P7, X8."""
    o = table(spark, sf_dir, "orders")
    points = F.when(F.col("o_orderkey") % 6 == 5, F.array().cast("array<string>")).when(F.col("o_orderkey") % 4 == 3, F.array(F.lit("search(q)"), F.lit("wipe (x)"), F.lit("done"))).otherwise(F.array(F.lit("search(q)"), F.lit(" search (r)"), F.lit("done")))
    ok = filters.valid_task(F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_orderpriority"), points, F.array(F.lit("met")), F.array(F.lit("search"), F.lit("fetch")))
    return o.select(F.col("o_orderkey").alias("id"), ok.alias("valid"), F.array_join(records.expected_tools(points), ",").alias("expected"))


@query(
    """WITH a AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '{"k":"7"}' WHEN 2 THEN '{"k":"3.5"}' WHEN 3 THEN '{"k":3.9}' WHEN 4 THEN '{"k":null}' ELSE '{"j":1}' END AS p FROM events)
  SELECT event_id, CASE WHEN event_id % 6 = 5 THEN 'Missing required parameters: k' WHEN json_type(p, '$.k') IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN NULL
    WHEN json_type(p, '$.k') = 'VARCHAR' AND regexp_full_match(json_extract_string(p, '$.k'), '\\s*[+-]?[0-9]+\\s*') THEN NULL ELSE 'Parameter ''k'' should be an integer' END AS fault FROM a"""
)
def validate_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10."""
    i = F.col("event_id") % 6
    args = F.when(i == 0, F.col("props")).when(i == 1, '{"k":"7"}').when(i == 2, '{"k":"3.5"}').when(i == 3, '{"k":3.9}').when(i == 4, '{"k":null}').otherwise('{"j":1}')
    return table(spark, sf_dir, "events").select("event_id", filters.check_arguments(args, [("k", "integer", True)]).alias("fault"))


@query(
    """WITH a AS (SELECT p_partkey, p_partkey % 3 AS tool, CASE p_partkey % 7 WHEN 0 THEN '{"x":"' || p_size || '","y":' || p_retailprice || '}' WHEN 1 THEN '{"x":' || p_retailprice || '}' WHEN 2 THEN '{"y":"1e3"}'
      WHEN 3 THEN '{"x":"ten","y":true}' WHEN 4 THEN '{"x":true,"y":"z"}' WHEN 5 THEN '{"x":null,"y":null}' ELSE '{}' END AS args, p_size, p_retailprice, p_partkey % 7 AS k FROM part)
  SELECT p_partkey AS id, CASE tool
      WHEN 0 THEN CASE WHEN k IN (2, 6) THEN 'Missing required parameters: x' WHEN k IN (3, 5) THEN 'Parameter ''x'' should be an integer' END
      WHEN 1 THEN CASE WHEN k IN (1, 6) THEN 'Missing required parameters: y' WHEN k IN (4, 5) THEN 'Parameter ''y'' should be a number' END
      ELSE CASE WHEN k = 6 THEN 'Missing required parameters: x, y' WHEN k = 1 THEN 'Missing required parameters: y' WHEN k = 2 THEN 'Missing required parameters: x' END END AS fault,
    CASE WHEN tool = 0 THEN CASE k WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) WHEN 4 THEN '1' END END AS x FROM a"""
)
def validate_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """calls of three tools with their own parameters; the integer as it is passed on."""
    k, tool = F.col("p_partkey") % 7, F.col("p_partkey") % 3
    args = F.when(k == 0, F.format_string('{"x":"%s","y":%s}', F.col("p_size").cast("string"), F.col("p_retailprice").cast("string"))).when(k == 1, F.format_string('{"x":%s}', F.col("p_retailprice").cast("string")))
    args = args.when(k == 2, '{"y":"1e3"}').when(k == 3, '{"x":"ten","y":true}').when(k == 4, '{"x":true,"y":"z"}').when(k == 5, '{"x":null,"y":null}').otherwise("{}")
    one = lambda name, kind, required: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit(required).cast("boolean").alias("required"))
    params = F.when(tool == 0, F.array(one("x", "integer", True))).when(tool == 1, F.array(one("y", "number", True), one("x", "string", False))).otherwise(F.array(one("x", "string", None), one("y", "array", None)))
    got = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), tool.alias("tool"), filters.check_call(args, params).alias("c"))
    return got.select("id", "c.fault", F.when(F.col("tool") == 0, F.col("c.values")["x"]).alias("x"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (value IS NULL) AS without_time FROM events GROUP BY event_type")
def tool_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("without_time"))


U_EVENT = UNIFORM.format(key="event_id")


@query(f"SELECT event_id, CASE WHEN {U_EVENT} < 0.85 THEN 'success' WHEN {U_EVENT} < 0.85 + 0.10 THEN 'partial_success' ELSE 'failure' END AS outcome FROM events")
def exec_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7."""
    return table(spark, sf_dir, "events").select("event_id", sampling.outcome(F.col("event_id")).alias("outcome"))


@query("SELECT event_id, event_type, event_type IN ('click', 'view', 'purchase') AS found, CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'tool_not_found' END AS error_type FROM events")
def tool_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12, T9."""
    registry = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in ("click", "view", "purchase")])).alias("name"))
    return joins.lookup_tools(table(spark, sf_dir, "events").select("event_id", "event_type"), registry, "event_type")


@query(
    """WITH k AS (SELECT l_orderkey, l_partkey, max(l_linenumber) AS pos FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY ALL),
  c AS (SELECT l_orderkey, count(*) AS n_tools FROM k GROUP BY l_orderkey HAVING count(*) >= 2),
  m AS (SELECT l_orderkey, p_brand AS name, max(pos) AS pos FROM k JOIN part ON l_partkey = p_partkey GROUP BY ALL),
  n AS (SELECT l_orderkey, string_agg(name, ',' ORDER BY pos, name) AS names FROM m GROUP BY l_orderkey)
  SELECT o_orderkey AS task_id, o_custkey AS agent_id, n_tools, names FROM orders JOIN customer ON o_custkey = c_custkey JOIN c ON c.l_orderkey = o_orderkey JOIN n ON n.l_orderkey = o_orderkey WHERE c_acctbal > 0"""
)
def match_tasks_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J6."""
    tasks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"), F.col("o_custkey").alias("agent_id"))
    agents = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("agent_id"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("task_id"), F.col("l_partkey").alias("tool_id")).agg(F.max("l_linenumber").alias("pos"))
    tools = table(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("tool_id"), F.col("p_brand").alias("name"))
    return joins.match_tasks(tasks, agents, lines, tools).withColumn("names", F.array_join("names", ","))


@query("SELECT o_orderkey AS task_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def pending_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, J3."""
    return joins.pending(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id")), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("task_id")), "task_id")


def _combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("tool_ids"))


COMBOS = "c AS (SELECT l_orderkey, list_sort(list(DISTINCT l_partkey)) AS tool_ids FROM lineitem GROUP BY l_orderkey)"


@query(f"WITH {COMBOS} SELECT l_orderkey, array_to_string(tool_ids, ',') AS tool_ids FROM c QUALIFY row_number() OVER (PARTITION BY tool_ids ORDER BY l_orderkey) = 1")
def combo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3."""
    return joins.dedup_combinations(_combos(spark, sf_dir), "tool_ids", "l_orderkey").select("l_orderkey", F.array_join("tool_ids", ",").alias("tool_ids"))


@query(
    f"""WITH {COMBOS} SELECT count(*) AS total, CAST(min(len(tool_ids)) AS INTEGER) AS least, CAST(max(len(tool_ids)) AS INTEGER) AS most, CAST(sum(len(tool_ids)) AS BIGINT) AS uses,
  (SELECT count(DISTINCT l_partkey) FROM lineitem) AS unique_tools, round(avg(len(tool_ids)), 2) AS avg_size, round(sum(len(tool_ids)) / (SELECT count(DISTINCT l_partkey) FROM lineitem), 2) AS avg_usage FROM c"""
)
def combo_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2."""
    return stats.combination_stats(_combos(spark, sf_dir))


@query(
    f"""WITH {COMBOS}, k AS (SELECT len(tool_ids) AS size, CASE WHEN l_orderkey % 3 = 0 THEN 'similarity' WHEN l_orderkey % 3 = 1 THEN 'random_walk' ELSE '' END AS method, CAST(l_orderkey % 41 AS VARCHAR) AS scenario FROM c),
  s AS (SELECT scenario AS value, count(*) AS n FROM k GROUP BY 1 ORDER BY n DESC, value LIMIT 10)
  SELECT 'size' AS kind, CAST(size AS VARCHAR) AS value, count(*) AS n FROM k GROUP BY size UNION ALL SELECT 'method', method, count(*) FROM k GROUP BY method UNION ALL SELECT 'scenario', value, n FROM s"""
)
def combo_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: the scenarios are a top-10 report."""
    key = F.col("l_orderkey")
    c = _combos(spark, sf_dir).withColumns({"generation_method": F.when(key % 3 == 0, "similarity").when(key % 3 == 1, "random_walk"), "scenario_id": key % 41})
    return stats.combination_distributions(c)


@query("SELECT l_partkey AS tool, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, tool LIMIT 10")
def top_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-10 report."""
    return stats.top_counts(table(spark, sf_dir, "lineitem"), "l_partkey", 10, "tool")


@query(
    """WITH s AS (SELECT p_size / 10.0 AS s FROM part) SELECT count(*) AS total, count(s) AS scored, round(avg(s), 2)::DOUBLE AS mean, min(s)::DOUBLE AS least, max(s)::DOUBLE AS most, count(*) FILTER (s >= 4.5) AS excellent,
  count(*) FILTER (s >= 4.0 AND s < 4.5) AS good, count(*) FILTER (s >= 3.0 AND s < 4.0) AS fair, count(*) FILTER (s < 3.0) AS poor,
  round(100.0 * count(*) FILTER (s >= 4.0) / count(*), 1)::DOUBLE AS high_quality_ratio, round(100.0 * count(*) FILTER (s < 3.0) / count(*), 1)::DOUBLE AS needs_improvement_ratio FROM s"""
)
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, X9."""
    return stats.evaluation_summary(table(spark, sf_dir, "part"), _score())


@query("SELECT coalesce(CASE WHEN p_size % 3 > 0 THEN p_brand END, '未知') AS recommendation, count(*) AS n FROM part GROUP BY 1")
def eval_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return stats.recommendation_counts(table(spark, sf_dir, "part"), F.when(F.col("p_size") % 3 > 0, F.col("p_brand")))


@query("SELECT d AS o_orderpriority, count(o_orderkey) AS n FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('9-UNUSED')) v(d) LEFT JOIN orders ON o_orderpriority = d GROUP BY d")
def difficulty_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5."""
    return stats.counts_over(table(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES)


@query("SELECT c_custkey AS agent_id, difficulty, CAST(i AS INTEGER) AS task_index FROM customer, (VALUES ('simple'), ('medium'), ('complex')) v(difficulty), range(2) r(i)")
def task_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11."""
    return joins.expand_tasks(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("agent_id")), DIFFICULTIES, 2)


@query("SELECT count(*) AS tasks, count(DISTINCT o_custkey) AS agents, round(count(*) / count(DISTINCT o_custkey), 2) AS tasks_an_agent, round(100.0 * count(*) / 1000000, 1)::DOUBLE AS success_rate FROM orders")
def task_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    return stats.task_summary(table(spark, sf_dir, "orders"), 1_000_000, "o_custkey")


@query(
    f"""WITH {COMBOS}, a AS (SELECT * FROM c WHERE len(tool_ids) >= 2)
  SELECT count(*) AS agents, round(avg(len(tool_ids)), 2) AS avg_tools, (SELECT count(DISTINCT t) FROM (SELECT unnest(tool_ids) AS t FROM a)) AS unique_tools, round(count(*) / (SELECT count(*) FROM c), 4)::DOUBLE AS success_rate FROM a"""
)
def agent_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7."""
    combos = _combos(spark, sf_dir)
    return stats.agent_stats(combos.filter(F.size("tool_ids") >= 2), "tool_ids", combos)


@query("SELECT o_orderkey FROM orders ORDER BY md5('7:' || o_orderkey) LIMIT 1000")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3, L4: a sample of 1000."""
    return sampling.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey"), 1000, F.col("o_orderkey"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 in an order."""
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50).select("o_orderkey")


@query("SELECT c_mktsegment AS scenario, count(*) AS n, CAST(floor(1000 / (SELECT count(DISTINCT c_mktsegment) FROM customer)) AS BIGINT) AS quota FROM customer GROUP BY 1 HAVING count(*) >= 3")
def scenario_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L6, F13."""
    c = table(spark, sf_dir, "customer").withColumnRenamed("c_mktsegment", "scenario")
    n = c.agg(F.countDistinct("scenario").alias("groups"))
    return filters.groups_of_size(c, "scenario", 3).join(F.broadcast(n)).select("scenario", "n", sampling.quota(1000, F.col("groups")).alias("quota"))


@query("""SELECT c_custkey, 'agent_' || substr(md5('{"key": ' || c_custkey || ', "name": ' || to_json(c_name) || ', "segment": ' || to_json(c_mktsegment) || '}'), 1, 8) AS id FROM customer""")
def content_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1."""
    fields = {"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "key": F.col("c_custkey")}
    return table(spark, sf_dir, "customer").select("c_custkey", text.content_id("agent", fields, raw=("key",)).alias("id"))


SCHEMA_SQL = """'{"name":' || to_json(p_name) || ',"description":' || to_json(p_type) || ',"parameters":{"type":"object","properties":{"brand":{"type":"string","description":' || to_json(p_brand)
  || CASE WHEN p_size > 25 THEN ',"enum":["' || p_brand || '"]' ELSE '' END || '},"size":{"type":"integer","description":"size"}},"required":' || CASE WHEN p_size % 2 = 0 THEN '["brand"' ELSE '[' END"""


def _tool_parameters() -> Column:
    brand = F.struct(F.lit("brand").alias("name"), F.lit("string").alias("type"), F.col("p_brand").alias("description"), (F.col("p_size") % 2 == 0).alias("required"), F.when(F.col("p_size") > 25, F.array("p_brand")).otherwise(F.array().cast("array<string>")).alias("enum"))
    size = F.struct(F.lit("size").alias("name"), F.lit("integer").alias("type"), F.lit("size").alias("description"), F.lit(None).cast("boolean").alias("required"), F.lit(None).cast("array<string>").alias("enum"))
    return F.array(brand, size)


@query(
    f"""SELECT p_partkey AS id, {SCHEMA_SQL} || CASE WHEN p_size % 2 = 0 THEN ',"size"]' ELSE '"size"]' END || '}}}}' AS required_schema, {SCHEMA_SQL} || ']}}}}' AS optional_schema FROM part"""
)
def function_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, P4."""
    make = lambda d: records.function_schema(F.col("p_name"), F.col("p_type"), _tool_parameters(), d)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), make(True).alias("required_schema"), make(False).alias("optional_schema"))


@query(
    f"""WITH {COMBOS}, s AS (SELECT p_partkey, {SCHEMA_SQL} || ']}}}}' AS s FROM part WHERE p_size > 10),
  l AS (SELECT l_orderkey AS o, string_agg(s, chr(10) || chr(10) ORDER BY p_partkey) AS tools FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN s ON l_partkey = p_partkey GROUP BY l_orderkey)
  SELECT 'agent_' || substr(md5('{{"combination": "' || l_orderkey || '"}}'), 1, 8) AS id, 'Tools: ' || coalesce(tools, '') AS system_prompt, len(tool_ids) AS n_tools FROM c LEFT JOIN l ON l_orderkey = o"""
)
def agent_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U5, P4, P9."""
    tools = table(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), _tool_parameters().alias("parameters"))
    return records.agent_records(_combos(spark, sf_dir), tools, "Tools: {tools_list}", "l_orderkey").select("id", "system_prompt", F.size("tools").cast("long").alias("n_tools"))


@query(
    """WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem),
  a AS (SELECT l_orderkey, string_agg('{"name":' || to_json(p_name) || ',"description":' || to_json(p_type) || '}', ', ' ORDER BY l_linenumber, l_partkey) AS s FROM l JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY l_orderkey)
  SELECT o_orderkey, coalesce('[' || s || ']', '[]') AS tools FROM orders LEFT JOIN a ON o_orderkey = l_orderkey"""
)
def tools_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    known = lines.join(table(spark, sf_dir, "part").filter("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"))
    item = F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("description")))
    lists = joins.ordered_tools_json(known, "l_orderkey", ["l_linenumber", "l_partkey"], item)
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce("tools", F.lit("[]")).alias("tools"))


@query(
    """WITH l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) SELECT l_orderkey, string_agg('- ' || p_name || ': ' || p_type, '\\n' ORDER BY l_linenumber, l_partkey) AS block
  FROM l JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey"""
)
def tools_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    known = lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    lists = known.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("description")))).alias("t"))
    return lists.select("l_orderkey", records.tools_block(F.col("t")).alias("block"))


@query(
    """WITH l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), k AS (SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS tools, count(*) AS n FROM l JOIN part ON l_partkey = p_partkey WHERE p_size > 20 GROUP BY 1)
  SELECT l_orderkey AS id, tools FROM k WHERE n >= 2"""
)
def agents_known_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12."""
    agents = _combos(spark, sf_dir).select(F.col("l_orderkey").alias("id"), F.col("tool_ids").alias("tools"))
    tools = table(spark, sf_dir, "part").filter("p_size > 20").select(F.col("p_partkey").alias("id"))
    return filters.known_tools(agents, tools).select("id", F.array_join("tools", ",").alias("tools"))


@query("SELECT source || '+' || w AS pair FROM (SELECT source, unnest(string_split(text, chr(10))) AS w FROM documents)")
def explode_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10."""
    return records.name_use_pairs(table(spark, sf_dir, "documents").withColumn("uses", F.split("text", "\n")), "source", "uses")


@query("SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN reverse(c_name) WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7."""
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = old.filter("c_custkey % 3 = 0").select("c_custkey", F.upper("c_name").alias("c_name"), F.when(F.col("c_custkey") % 2 == 0, "NEW").alias("c_mktsegment"))
    new = new.withColumn("pos", F.lit(0)).unionByName(new.filter("c_custkey % 9 = 0").withColumns({"c_name": F.reverse(F.initcap("c_name")), "pos": F.lit(1)}))
    return joins.upsert(old, new, "c_custkey", "pos")


@query("SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS price FROM customer UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    return records.merge_batches(a, b)


@query("SELECT count(*) AS rows, count(DISTINCT source) AS files, count(DISTINCT lang) AS domains FROM documents")
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    return stats.batch_totals(table(spark, sf_dir, "documents"), "source", "lang")


@query("SELECT coalesce(sum(n_chars), 0)::BIGINT AS n_chars FROM documents")
def usage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16."""
    return stats.usage_totals(table(spark, sf_dir, "documents"), "n_chars")


@query(
    """SELECT doc_id, 'scenario_' || substr(md5('{"domain": ' || to_json(lang) || ', "name": ' || to_json(source) || '}'), 1, 8) AS id, source AS name, lang AS domain, length(text) AS described, 0::INTEGER AS users FROM documents"""
)
def normalize_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6."""
    s = records.normalize_scenario(F.col("source"), F.col("text"), F.col("lang"), F.lit(None).cast("string"), F.lit(None).cast("array<string>"))
    return table(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", "s.id", "s.name", "s.domain", F.length("s.description").cast("long").alias("described"), F.size("s.target_users").alias("users"))


@query(
    """SELECT p_partkey, 'tool_' || substr(md5('{"name": ' || to_json(p_name) || ', "scenario": ' || to_json(p_brand) || '}'), 1, 8) AS id, 'object' AS return_type, 2 AS parameters,
  CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS required FROM part"""
)
def normalize_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5."""
    t = records.normalize_tool(F.col("p_name"), F.col("p_type"), _tool_parameters(), F.lit(None).cast("string"), F.col("p_brand"))
    needed = F.size(F.filter("t.parameters", lambda p: p["required"]))
    return table(spark, sf_dir, "part").select("p_partkey", t.alias("t")).select("p_partkey", "t.id", "t.return_type", F.size("t.parameters").alias("parameters"), needed.alias("required"))


@query(
    """SELECT o_orderkey, CASE WHEN lower(substr(o_orderpriority, 3)) IN ('simple', 'medium', 'complex') THEN lower(substr(o_orderpriority, 3)) ELSE 'medium' END AS difficulty,
  CASE WHEN o_orderstatus = 'F' THEN 'single_turn' ELSE 'multi_turn' END AS task_type FROM orders"""
)
def task_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15."""
    f = records.task_fields(F.lower(F.substring("o_orderpriority", 3, 100)), F.when(F.col("o_orderstatus") == "F", "single_turn").otherwise("other"))
    return table(spark, sf_dir, "orders").select("o_orderkey", f.alias("f")).select("o_orderkey", "f.difficulty", "f.task_type")


U_P = "(('0x' || substr(md5('7:' || c_custkey || ':personality'), 1, 13))::BIGINT / 4503599627370496.0)"
U_S = "(('0x' || substr(md5('7:' || c_custkey || ':style'), 1, 13))::BIGINT / 4503599627370496.0)"


@query(
    f"""WITH p AS (SELECT c_custkey, ['friendly', 'impatient', 'cautious', 'casual'][CAST(floor({U_P} * 4) AS INTEGER) + 1] AS personality_type, ['formal', 'informal', 'life_oriented'][CAST(floor({U_S} * 3) AS INTEGER) + 1] AS style_type FROM customer)
  SELECT c_custkey, personality_type || '_' || style_type || '_user' AS name, personality_type, style_type FROM p"""
)
def persona_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L8, P13."""
    return table(spark, sf_dir, "customer").select("c_custkey", records.draw_persona(F.col("c_custkey")).alias("p")).select("c_custkey", "p.*")


@query("SELECT c_custkey, 'Agent ' || c_name || ' serves ' || c_mktsegment || '.' AS prompt FROM customer")
def prompt_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, U5."""
    return table(spark, sf_dir, "customer").select("c_custkey", records.fill("Agent {name} serves {segment}.", name=F.col("c_name"), segment=F.col("c_mktsegment")).alias("prompt"))


@query(f"WITH {COMBOS} SELECT l_orderkey, CAST(tool_ids[1] AS VARCHAR) AS scenario_id FROM c WHERE len(tool_ids) > 0")
def primary_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D4."""
    c = _combos(spark, sf_dir).withColumn("scenario_ids", F.col("tool_ids").cast("array<string>"))
    return joins.primary_scenario(c).select("l_orderkey", "scenario_id")


@query("SELECT lang AS domain, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, domain LIMIT 10")
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-10 report."""
    return stats.top_counts(table(spark, sf_dir, "documents"), "lang", 10, "domain")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, ts AS parsed FROM events")
def iso_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10, P14."""
    e = table(spark, sf_dir, "events").withColumn("iso", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return e.select("event_id", "iso", F.col("ts").alias("parsed"))


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL")
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14."""
    return filters.not_null(table(spark, sf_dir, "events"), "event_type", "value").select("event_id", "user_id", "event_type")


@query()
def simulated_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1-T9, U7-U9, M1 with the stub: a session for every order's task."""
    from ..operators import provider

    tasks = _combos(spark, sf_dir).select(F.col("l_orderkey").alias("task_id"), (F.col("l_orderkey") % 100).alias("agent_id"), F.col("tool_ids").cast("array<string>").alias("tools"))
    return provider.run_sessions(tasks)


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 50 <> 0 THEN 'answer ' || substr(md5(c_name), 1, 12) END AS content, CASE WHEN c_custkey % 50 = 0 THEN 'provider failed' END AS error FROM customer"""
)
def provider_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M2, M4-M8 with the stub: keyed answers with errors kept."""
    from ..operators import provider

    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 50 == 0, "FAIL").otherwise(F.col("c_name")).alias("prompt"))
    return provider.complete(c, "c_custkey", "prompt")


@query("SELECT p_partkey, 256 AS width, CAST(NULL AS VARCHAR) AS error FROM part")
def provider_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M9 with the stub."""
    from ..operators import provider

    return provider.embed(table(spark, sf_dir, "part"), "p_partkey", "p_name", 256).select("p_partkey", F.size("embedding").alias("width"), "error")


@query("SELECT p_partkey, CAST(p_size AS BIGINT) * 2 AS double, CAST(NULL AS VARCHAR) AS error FROM part")
def chunked_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2."""
    from ..operators import provider

    return provider.map_batches(table(spark, sf_dir, "part").select("p_partkey", "p_size"), lambda b: b.assign(double=b["p_size"] * 2)[["p_partkey", "double"]], "p_partkey long, double long")


@query("SELECT event_type, count(*) AS n, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS start FROM events GROUP BY ALL")
def usage_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form of the windowed stream (streaming extension)."""
    from ..streaming import sessions

    return sessions.windowed_usage(table(spark, sf_dir, "events")).select("event_type", "n", F.col("start").cast("timestamp_ntz").alias("start"))


@query(
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE - INTERVAL 1 MICROSECOND THEN 1 ELSE 0 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
  SELECT user_id, count(*) AS n, min(ts) AS start FROM s GROUP BY user_id, k"""
)
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form of the session windows (streaming extension)."""
    from ..streaming import sessions

    return sessions.session_windows(table(spark, sf_dir, "events")).select("user_id", "n", F.col("start").cast("timestamp_ntz").alias("start"))


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS agent_id, CASE WHEN o_orderkey % 3 = 0 THEN 'simple' WHEN o_orderkey % 3 = 1 THEN 'complex' END AS difficulty,
    len(o_orderpriority) + 1 AS n_tools, o_orderdate + INTERVAL 5 MICROSECOND AS created_at, CAST(NULL AS VARCHAR) AS error
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, 0, NULL, CASE WHEN o_orderkey % 2 = 0 THEN 'unknown difficulty' ELSE 'no agent_id' END FROM orders WHERE o_orderkey % 7 = 0"""
)
def entity_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks as JSON with times, lists, nested records and enumerations, and read back with rejects."""
    key, odd = F.col("o_orderkey"), F.col("o_orderkey") % 7 == 0
    level = F.when(odd & (key % 2 == 0), "hard").when(key % 3 == 0, "simple").when(key % 3 == 1, "complex")
    rubric = F.struct(F.array("o_orderstatus").alias("success_criteria"), F.array().cast("array<string>").alias("tool_usage_expectations"), F.array("o_orderpriority").alias("checkpoints"))
    tools = F.transform(F.sequence(F.lit(0), F.length("o_orderpriority")), lambda i: i.cast("string"))
    text = entities.to_entity_json(
        key.cast("string").alias("id"), F.when(~odd | (key % 2 == 0), F.col("o_custkey").cast("string")).alias("agent_id"), level.alias("difficulty"), tools.alias("expected_tools"),
        rubric.alias("rubric"), (F.col("o_orderdate").cast("timestamp") + F.expr("interval 5 microseconds")).alias("created_at"), nulls=False,
    )
    rows, bad = entities.entities_from_json(table(spark, sf_dir, "orders").select(key.cast("string").alias("key"), text.alias("j")), "j", "task")
    good = rows.select("id", "agent_id", "difficulty", F.size("expected_tools").cast("long").alias("n_tools"), F.col("created_at").cast("timestamp_ntz").alias("created_at"), F.lit(None).cast("string").alias("error"))
    return good.union(bad.select("key", F.lit(None), F.lit(None), F.lit(0), F.lit(None).cast("timestamp_ntz"), "error"))


@query(
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'friendly' WHEN 1 THEN 'impatient' WHEN 2 THEN 'cautious' WHEN 3 THEN 'casual' END AS personality,
  CASE c_custkey % 5 WHEN 0 THEN 'warm and polite, thanks for help and forgives slips' WHEN 1 THEN 'wants answers at once and has little time for questions'
    WHEN 2 THEN 'checks every step and asks what might go wrong' WHEN 3 THEN 'relaxed, talks as to a friend and leaves details open' END AS note FROM customer"""
)
def persona_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a personality is like, by a lookup; unknown ones have no note."""
    kinds = F.array(*[F.lit(k) for k in entities.PERSONALITY_NOTES])
    named = table(spark, sf_dir, "customer").select("c_custkey", F.get(kinds, (F.col("c_custkey") % 5).cast("int")).alias("personality"))
    return named.withColumn("note", entities.describe(F.col("personality"), entities.PERSONALITY_NOTES))
