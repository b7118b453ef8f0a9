"""Queries that run streams over the tables to their end and return what these have written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from ..streaming import expiring, incremental
from .registry import query, table
from .source_queries import io_folder

GAP, LATE, TURNS = "12 hours", "10 minutes", 6


@query(
    f"""WITH m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS mark FROM events),
e AS (SELECT DISTINCT user_id, event_id, ts, event_type = 'purchase' AS fin, mark FROM events, m WHERE ts < mark),
n AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR AND NOT lag(fin) OVER w THEN 0 ELSE 1 END AS new FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
p AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS part FROM n),
c AS (SELECT *, (row_number() OVER (PARTITION BY user_id, part ORDER BY ts, event_id) - 1) // {TURNS} AS cut FROM p),
s AS (SELECT user_id, part, cut, min(ts) AS start, max(ts) AS "end", count(*) AS turns, bool_or(fin) AS fin, first(mark) AS mark FROM c GROUP BY 1, 2, 3),
r AS (SELECT *, CASE WHEN fin THEN 'finish' WHEN turns >= {TURNS} THEN 'limit' WHEN lead(part) OVER (PARTITION BY user_id ORDER BY part, cut) IS NOT NULL OR "end" + INTERVAL 12 HOUR < mark THEN 'gap' END AS reason FROM s)
SELECT user_id, start, "end", turns, reason FROM r WHERE reason IS NOT NULL"""
)
def expiring_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2, T4 (streaming): sessions of users, closed by a purchase, at six events or after twelve hours, from a stream with state that
    expires."""
    path = io_folder(spark, "sessions")
    expiring.use_store(spark)
    stream = files.stream_parquet(spark, f"{sf_dir}/events.parquet")
    closed = expiring.closed_sessions(stream, F.col("event_type") == "purchase", GAP, TURNS, LATE)
    run = closed.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    rows = spark.read.schema(closed.schema).parquet(f"{path}/rows")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(
    """WITH l AS (SELECT user_id, arg_max({'e': event_id, 't': event_type, 'v': value}, {'ts': ts, 'e': event_id}) AS r FROM events GROUP BY user_id)
  SELECT user_id, r.e AS event_id, r.t AS event_type, r.v AS value FROM l"""
)
def incremental_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest event of every user in a keyed table that takes up three batches of files, each by a run of a stream."""
    path = io_folder(spark, "upserts")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    kept = incremental.KeyedTable(spark, f"{path}/table", "user_id", ["ts", "event_id"])
    for n in range(3):
        events.filter(F.pmod("event_id", F.lit(3)) == n).write.mode("append").parquet(f"{path}/arrived")
        incremental.feed(files.stream_parquet(spark, f"{path}/arrived"), kept, f"{path}/offsets")
    return kept.rows().select("user_id", "event_id", "event_type", "value")


@query("SELECT o_orderkey AS task, o_custkey AS agent FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 3)")
def pending_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders that neither of two batches of lines, taken up one after the other and merged, has dealt with."""
    path = io_folder(spark, "pending")
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber > 3").select("l_orderkey", "l_linenumber", "l_quantity")
    done = incremental.KeyedTable(spark, f"{path}/table", "l_orderkey", ["l_linenumber"])
    for n in range(2):
        lines.filter(F.pmod("l_linenumber", F.lit(2)) == n).write.mode("append").parquet(f"{path}/arrived")
        incremental.feed(files.stream_parquet(spark, f"{path}/arrived"), done, f"{path}/offsets")
    done.compact()
    return done.pending(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task"), F.col("o_custkey").alias("agent")), "task")
