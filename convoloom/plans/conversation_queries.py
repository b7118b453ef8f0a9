"""Queries over conversations. Their turns carry derived messages: calls in several spellings, observations, finish marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_text, text
from ..operators import conversation, filters, joins, training
from .registry import query, run_sql, table

#: The same text runs on both engines.
TURNS = """
SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'execution' ELSE role END AS role,
  CASE role WHEN 'user' THEN 'user' WHEN 'assistant' THEN 'agent' WHEN 'system' THEN 'execution' ELSE role END AS speaker,
  CASE WHEN role = 'assistant' AND (conv_id * 7 + turn) % 16 IN (1, 2, 3, 4) THEN 'execution' WHEN role = 'assistant' THEN 'user' ELSE 'agent' END AS recipient,
  CASE WHEN role = 'user' AND conv_id % 2 = 0 AND turn = max(turn) OVER (PARTITION BY conv_id) THEN text || ' Finish Conversation.'
    WHEN role = 'user' THEN text
    WHEN role = 'system' THEN CASE WHEN conv_id % 3 = 0 THEN '[{"a":1,"metadata":{"t":2}},3,"done",true,null]' ELSE text END
    WHEN (conv_id * 7 + turn) % 16 = 1 THEN text || ' {"name":"search","arguments":{"q":1}} ok'
    WHEN (conv_id * 7 + turn) % 16 = 2 THEN 'call ```json {"name":"lookup","arguments":{"id":2}} ``` done'
    WHEN (conv_id * 7 + turn) % 16 = 3 THEN 'see ``` {"name":"fetch","arguments":{}} ```'
    WHEN (conv_id * 7 + turn) % 16 = 4 AND conv_id % 5 = 0 THEN '{"name":"solo"}'
    WHEN (conv_id * 7 + turn) % 16 = 4 THEN '{"name":"full","arguments":{"x":{"y":1}}}'
    WHEN (conv_id * 7 + turn) % 16 = 5 THEN '{"name":"bad","arguments":"text"}'
    WHEN (conv_id * 7 + turn) % 16 = 6 THEN '{"name":"  ","arguments":{}}'
    WHEN (conv_id * 7 + turn) % 16 = 7 THEN '{"name":broken'
    WHEN (conv_id * 7 + turn) % 16 = 8 THEN '```json [{"name":"a","arguments":{}},{"name":"b","arguments":{"x":1}}] ```'
    ELSE text END AS message
FROM <conversations>
"""
SQL_TURNS = TURNS.replace("<conversations>", "conversations")
WITH = f"WITH t AS ({SQL_TURNS}) "


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, sf_dir, TURNS, "conversations")


PREFILTER = """
, p AS (SELECT conv_id, count(*) AS n_turns, coalesce(bool_or(speaker = 'user') AND bool_or(speaker = 'agent') AND arg_max(speaker, turn) = 'user'
  AND contains(lower(arg_max(message, turn)), 'finish conversation'), false) AS passed FROM t GROUP BY conv_id)
"""


@query(WITH + PREFILTER + "SELECT conv_id, n_turns, passed FROM p")
def traj_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7."""
    return filters.prefilter_conversations(turns(spark, sf_dir))


@query(WITH + PREFILTER + "SELECT count(*) AS total, count(*) FILTER (passed) AS passed, round(100.0 * count(*) FILTER (passed) / count(*), 1) AS pass_rate FROM p")
def prefilter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7b."""
    p = filters.prefilter_conversations(turns(spark, sf_dir))
    return p.agg(F.count("*").alias("total"), F.count_if("passed").alias("passed")).withColumn("pass_rate", F.round(100.0 * F.col("passed") / F.col("total"), 1))


@query(WITH + "SELECT conv_id, string_agg(speaker || ': ' || message, chr(10) ORDER BY turn) AS history FROM t WHERE speaker IN ('user', 'agent', 'execution') GROUP BY conv_id")
def conversation_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11."""
    return conversation.history(turns(spark, sf_dir))


@query(
    WITH + """SELECT conv_id, count(*) AS n_turns, string_agg(speaker || ': ' || message, chr(10) ORDER BY turn) AS turns,
  coalesce(string_agg(CASE WHEN speaker = 'execution' THEN speaker || ': ' || message END, chr(10) ORDER BY turn), '') AS tool_results FROM t GROUP BY conv_id"""
)
def evaluation_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P12."""
    return conversation.evaluation_payload(turns(spark, sf_dir))


@query(
    WITH + """SELECT conv_id, turn, CASE speaker WHEN 'user' THEN 'user' WHEN 'agent' THEN 'assistant' ELSE 'execution' END AS role, message, recipient
  FROM t WHERE speaker IN ('user', 'agent', 'execution')"""
)
def role_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers to roles and back give the same rows."""
    t = turns(spark, sf_dir).withColumn("speaker", conversation.speaker_of(conversation.role_of(F.col("speaker"))))
    m = conversation.training_messages(t.withColumn("message", F.to_json(F.struct("turn", "message"))))
    e = m.select("conv_id", F.explode("messages").alias("m")).select("conv_id", F.from_json("m.content", "turn long, message string").alias("c"), "m.role", "m.recipient")
    return e.select("conv_id", "c.turn", "role", "c.message", "recipient")


#: What each derived spelling holds.
CALLS = """
CASE WHEN role <> 'assistant' THEN []::VARCHAR[]
  WHEN (conv_id * 7 + turn) % 16 = 1 THEN ['{"name":"search","arguments":{"q":1}}']
  WHEN (conv_id * 7 + turn) % 16 = 2 THEN ['{"name":"lookup","arguments":{"id":2}}']
  WHEN (conv_id * 7 + turn) % 16 = 3 THEN ['{"name":"fetch","arguments":{}}']
  WHEN (conv_id * 7 + turn) % 16 = 4 AND conv_id % 5 = 0 THEN ['{"name":"solo"}']
  WHEN (conv_id * 7 + turn) % 16 = 4 THEN ['{"name":"full","arguments":{"x":{"y":1}}}']
  WHEN (conv_id * 7 + turn) % 16 = 8 THEN ['{"name":"a","arguments":{}}', '{"name":"b","arguments":{"x":1}}']
  ELSE []::VARCHAR[] END
"""


@query(
    WITH + """, b AS (SELECT conv_id, turn, message, [trim(regexp_extract(message, '```json\\s*(.*?)\\s*```', 1, 's')), trim(regexp_extract(message, '```\\s*(.*?)\\s*```', 1, 's')), trim(regexp_replace(message, '\\s+', ' ', 'g'))]
    || regexp_extract_all(message, '\\{[^{}]*(?:\\{[^{}]*\\}[^{}]*)*\\}') AS c FROM t)
  SELECT conv_id, turn, len(list_filter(c, lambda s: CASE WHEN json_valid(s) THEN json_type(s) = 'OBJECT' AND coalesce(json_type(s, '$.name') = 'VARCHAR', false) AND coalesce(trim(json_extract_string(s, '$.name')), '') <> ''
    AND coalesce(json_type(s, '$.arguments'), 'OBJECT') = 'OBJECT' ELSE false END)) > 0 AS has_call FROM b"""
)
def tool_calls_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3, F8."""
    return turns(spark, sf_dir).select("conv_id", "turn", json_text.contains_tool_call(F.col("message")).alias("has_call"))


@query(WITH + f"SELECT conv_id, turn, json_extract_string(c, '$.name') AS name, CAST(pos AS BIGINT) AS pos FROM (SELECT conv_id, turn, unnest(c) AS c, unnest(range(len(c))) AS pos FROM (SELECT conv_id, turn, {CALLS} AS c FROM t))")
def tool_calls_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a call."""
    calls = turns(spark, sf_dir).select("conv_id", "turn", F.posexplode(json_text.extract_tool_calls(F.col("message"))).alias("pos", "c"))
    return calls.select("conv_id", "turn", F.get_json_object("c", "$.name").alias("name"), F.col("pos").cast("long").alias("pos"))


@query(
    WITH + """SELECT conv_id, turn, CASE WHEN json_valid(message) THEN CAST(message AS JSON)::VARCHAR
    WHEN message LIKE '%```json%' THEN CASE WHEN json_valid(regexp_extract(message, '```json\\s*(.*?)\\s*```', 1, 's')) THEN regexp_extract(message, '```json\\s*(.*?)\\s*```', 1, 's') END
    WHEN message LIKE '%```%' THEN CASE WHEN json_valid(regexp_extract(message, '```\\s*(.*?)\\s*```', 1, 's')) THEN regexp_extract(message, '```\\s*(.*?)\\s*```', 1, 's') END END IS NOT NULL AS parsed FROM t"""
)
def parse_llm_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2."""
    return turns(spark, sf_dir).select("conv_id", "turn", json_text.parse_llm_json(F.col("message")).isNotNull().alias("parsed"))


@query(
    WITH + """SELECT conv_id, turn, CASE WHEN role <> 'assistant' THEN trim(message) WHEN (conv_id * 7 + turn) % 16 = 1 THEN '{"name":"search","arguments":{"q":1}}'
    WHEN (conv_id * 7 + turn) % 16 = 2 THEN '{"name":"lookup","arguments":{"id":2}}' WHEN (conv_id * 7 + turn) % 16 = 3 THEN '{"name":"fetch","arguments":{}}'
    WHEN (conv_id * 7 + turn) % 16 = 8 THEN '[{"name":"a","arguments":{}},{"name":"b","arguments":{"x":1}}]' ELSE trim(message) END AS value FROM t"""
)
def balanced_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5."""
    return turns(spark, sf_dir).select("conv_id", "turn", json_text.balanced_json("message").alias("value"))


TRAINING = f"""
, l AS (SELECT *, max(turn) OVER (PARTITION BY conv_id) AS last, {CALLS} AS c FROM t)
, r AS (SELECT conv_id, turn,
    CASE WHEN role = 'user' THEN 'human' WHEN role = 'execution' THEN 'observation' WHEN recipient = 'execution' THEN 'function_call' ELSE 'gpt' END AS "from",
    CASE WHEN role = 'assistant' AND recipient = 'execution' THEN c[1] WHEN role = 'execution' AND message LIKE '[{{"a":1%' THEN '{{"a": 1}}' || chr(10) || '3' || chr(10) || 'done' || chr(10) || 'True' || chr(10) || 'None' ELSE message END AS value,
    NOT (role = 'assistant' AND recipient = 'execution') OR c[1] LIKE '%arguments%' AS valid
  FROM l WHERE NOT (turn = last AND role = 'user') AND role IN ('user', 'assistant', 'execution'))
"""


@query(WITH + TRAINING + 'SELECT conv_id, turn, "from", value, valid FROM r')
def training_rows_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10, X6."""
    return training.training_turns(turns(spark, sf_dir))


@query(WITH + TRAINING + """SELECT conv_id, string_agg("from" || '=' || value, chr(10) ORDER BY turn) AS conversations FROM r GROUP BY conv_id HAVING bool_and(valid)""")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows, rejected conversations left out."""
    rows = training.training_rows(turns(spark, sf_dir))
    return rows.select("conv_id", F.array_join(F.transform("conversations", lambda m: F.concat_ws("=", m["from"], m["value"])), "\n").alias("conversations"))


@query(
    WITH + TRAINING + """, c AS (SELECT conv_id, string_agg("from" || '=' || value, chr(10) ORDER BY turn) AS conversations FROM r GROUP BY conv_id HAVING bool_and(valid)),
  j AS (SELECT l_orderkey, string_agg('{"name":' || to_json(p_name) || ',"description":' || to_json(p_type) || '}', ', ' ORDER BY l_linenumber, l_partkey) AS s
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey WHERE p_size > 10 GROUP BY l_orderkey)
  SELECT conv_id, conversations, coalesce('[' || s || ']', '[]') AS tools FROM c LEFT JOIN j ON conv_id = l_orderkey"""
)
def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations beside the tools of their agent."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    known = lines.join(table(spark, sf_dir, "part").filter("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"))
    item = F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("description")))
    tools = joins.ordered_tools_json(known, "l_orderkey", ["l_linenumber", "l_partkey"], item).withColumnRenamed("l_orderkey", "conv_id")
    rows = training.training_table(turns(spark, sf_dir), tools)
    return rows.select("conv_id", F.array_join(F.transform("conversations", lambda m: F.concat_ws("=", m["from"], m["value"])), "\n").alias("conversations"), "tools")


@query(
    WITH + TRAINING + """, g AS (SELECT conv_id FROM r GROUP BY conv_id HAVING bool_and(valid))
  SELECT total, converted, total - converted AS rejected, round(100.0 * converted / total, 1) AS success_rate
  FROM (SELECT (SELECT count(DISTINCT conv_id) FROM t) AS total, (SELECT count(*) FROM g) AS converted)"""
)
def conversion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13."""
    t = turns(spark, sf_dir)
    return training.conversion_counts(t, training.training_rows(t))


@query(
    WITH + """, g AS (SELECT conv_id, 'agent_' || (conv_id % 7) AS agent_id, count(*) AS n_turns, arg_max(speaker, turn) AS last_speaker, arg_max(recipient, turn) AS last_recipient, arg_max(message, turn) AS m FROM t GROUP BY conv_id)
  , s AS (SELECT *, 'session_' || substr(md5('{"agent_id": "' || agent_id || '", "task_id": "' || conv_id || '"}'), 1, 8) AS session_id, n_turns >= 6 OR contains(lower(m), 'finish conversation') AS ended FROM g)
  SELECT conv_id, agent_id, session_id, n_turns, last_speaker, last_recipient, ended, CASE WHEN ended THEN 'completed' ELSE 'active' END AS status,
    'trajectory_' || substr(md5('{"agent_id": "' || agent_id || '", "session_id": "' || session_id || '", "task_id": "' || conv_id || '"}'), 1, 8) AS trajectory_id FROM s"""
)
def session_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T2, T4, T5, T12."""
    t = turns(spark, sf_dir).withColumn("agent_id", F.concat(F.lit("agent_"), (F.col("conv_id") % 7).cast("string")))
    return conversation.sessions(t, max_turns=6)


@query(WITH + "SELECT conv_id, CASE arg_max(recipient, turn) WHEN 'agent' THEN 'agent' WHEN 'execution' THEN 'execution' ELSE 'user' END AS next FROM t GROUP BY conv_id")
def route_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3."""
    return turns(spark, sf_dir).groupBy("conv_id").agg(F.max_by("recipient", "turn").alias("r")).select("conv_id", conversation.next_speaker(F.col("r")).alias("next"))


@query(
    WITH + """, g AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id) SELECT count(*) AS sessions, CAST(sum(n) AS BIGINT) AS turns, max(n) AS longest, round(avg(n), 2) AS avg_turns FROM g"""
)
def coordinator_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T13."""
    g = turns(spark, sf_dir).groupBy("conv_id").agg(F.count("*").alias("n"))
    return g.agg(F.count("*").alias("sessions"), F.sum("n").alias("turns"), F.max("n").alias("longest"), F.round(F.avg("n"), 2).alias("avg_turns"))


@query("SELECT conv_id, turn, round(CASE WHEN trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) * 1.3 END, 4)::DOUBLE AS tokens FROM conversations")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15."""
    from .registry import table

    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.round(text.token_estimate(F.col("text")), 4).alias("tokens"))


@query()
def text_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn against the one before."""
    from pyspark.sql import Window

    t = turns(spark, sf_dir)
    before = F.lag("message").over(Window.partitionBy("conv_id").orderBy("turn"))
    return t.withColumn("before", before).select("conv_id", "turn", text.text_similarity("message", "before").alias("ratio"))
