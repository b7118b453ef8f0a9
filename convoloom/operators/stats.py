"""Summaries of every stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import last_wins

UNKNOWN = "未知"  # fixed value: the bucket of rows without a recommendation


def evaluation_summary(df: DataFrame, score: Column) -> DataFrame:
    """A1: counts, mean, extremes, buckets and the shares of high quality and of those to improve, over all rows, scored or not."""
    n = F.count("*")
    pct = lambda c: F.round(100.0 * F.count_if(c) / n, 1)
    return df.agg(
        n.alias("total"), F.count(score).alias("scored"), F.round(F.avg(score), 2).alias("mean"), F.min(score).alias("least"), F.max(score).alias("most"),
        F.count_if(score >= 4.5).alias("excellent"), F.count_if((score >= 4.0) & (score < 4.5)).alias("good"), F.count_if((score >= 3.0) & (score < 4.0)).alias("fair"),
        F.count_if(score < 3.0).alias("poor"), pct(score >= 4.0).alias("high_quality_ratio"), pct(score < 3.0).alias("needs_improvement_ratio"),
    ).filter(F.col("total") > 0)


def recommendation_counts(df: DataFrame, recommendation: Column) -> DataFrame:
    """A1: rows by recommendation, those without one in a bucket of their own."""
    return df.groupBy(F.coalesce(recommendation, F.lit(UNKNOWN)).alias("recommendation")).agg(F.count("*").alias("n"))


def combination_stats(combos: DataFrame, tools_col: str = "tool_ids") -> DataFrame:
    """A2: number of combinations, their sizes, distinct tools and uses a tool, in one row."""
    size = F.size(tools_col)
    sizes = combos.agg(F.count("*").alias("total"), F.min(size).alias("least"), F.max(size).alias("most"), F.sum(size).cast("long").alias("uses"))
    tools = combos.select(F.explode(tools_col).alias("t")).agg(F.countDistinct("t").alias("unique_tools"))
    return sizes.join(F.broadcast(tools)).withColumns({"avg_size": F.round(F.col("uses") / F.col("total"), 2), "avg_usage": F.round(F.col("uses") / F.col("unique_tools"), 2)})


def combination_distributions(combos: DataFrame, tools_col: str = "tool_ids", method_col: str = "generation_method", scenario_col: str = "scenario_id", top: int = 10) -> DataFrame:
    """A2: (kind, value, n): combinations by size, by method, and by scenario, of the latter the ``top`` most frequent (ties by
    value). Missing methods and scenarios count as empty; a missing list has no size."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    sizes = combos.filter(F.col(tools_col).isNotNull()).groupBy(F.size(tools_col).cast("string").alias("value")).agg(F.count("*").alias("n"))
    methods = combos.groupBy(text(method_col).alias("value")).agg(F.count("*").alias("n"))
    scenarios = top_counts(combos, text(scenario_col), top, "value")
    named = [df.select(F.lit(kind).alias("kind"), "value", "n") for kind, df in (("size", sizes), ("method", methods), ("scenario", scenarios))]
    return named[0].unionByName(named[1]).unionByName(named[2])


def top_counts(df: DataFrame, key: Column | str, n: int = 10, name: str = "key") -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    k = F.col(key) if isinstance(key, str) else key
    return df.select(k.alias(name)).filter(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name).limit(n)


def counts_over(df: DataFrame, key: str, domain: tuple[str, ...]) -> DataFrame:
    """A5: counts for a fixed list of values, zeros included; other values do not count."""
    fixed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(d) for d in domain])).alias(key))
    got = df.filter(F.col(key).isin(*domain)).groupBy(key).agg(F.count("*").alias("n"))
    return fixed.join(got, key, "left").select(key, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def task_summary(tasks: DataFrame, requested: int | Column, agent_col: str = "agent_id") -> DataFrame:
    """Tasks, agents, tasks an agent and the share of requested tasks that exist, in per cent."""
    want = F.lit(requested) if isinstance(requested, int) else requested
    return tasks.agg(F.count("*").alias("tasks"), F.countDistinct(agent_col).alias("agents")).select(
        "tasks", "agents", F.round(F.col("tasks") / F.col("agents"), 2).alias("tasks_an_agent"), F.round(100.0 * F.col("tasks") / want, 1).alias("success_rate")
    )


def agent_stats(agents: DataFrame, tools_col: str = "tools", combinations: DataFrame | None = None) -> DataFrame:
    """Agents, tools an agent and distinct tools; with ``combinations`` the share of them that became agents (0 of none)."""
    a = agents.agg(F.count("*").alias("agents"), F.sum(F.size(tools_col)).alias("s"))
    t = agents.select(F.explode(tools_col).alias("t")).agg(F.countDistinct("t").alias("unique_tools"))
    out = a.join(F.broadcast(t)).select("agents", F.round(F.col("s") / F.col("agents"), 2).alias("avg_tools"), "unique_tools")
    if combinations is None:
        return out
    rate = F.round(F.when(F.col("c") > 0, F.col("agents") / F.col("c")).otherwise(0.0), 4)
    return out.join(F.broadcast(combinations.agg(F.count("*").alias("c")))).withColumn("success_rate", rate).drop("c")


def coverage(df: DataFrame, has: Column) -> DataFrame:
    """Rows, rows that have something, and their share in per cent."""
    return df.agg(F.count("*").alias("total"), F.count_if(has).alias("present")).withColumn("coverage", F.round(F.when(F.col("total") > 0, 100.0 * F.col("present") / F.col("total")).otherwise(0.0), 2))


def batch_totals(df: DataFrame, file_col: str, domain_col: str) -> DataFrame:
    """A10: rows, files and distinct domains over all batches."""
    return df.agg(F.count("*").alias("rows"), F.countDistinct(file_col).alias("files"), F.countDistinct(domain_col).alias("domains"))


def usage_totals(df: DataFrame, *cols: str) -> DataFrame:
    """Sums of usage counters."""
    return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols])


def merge_evaluations(tools: DataFrame, evals: DataFrame, id_col: str = "id", default: float = 3.0, pos_col: str | None = None) -> DataFrame:
    """Every tool with its score, or the default where the evaluation failed or is missing, and whether it failed. Of
    repeated evaluations the last by ``pos_col`` counts, and without that the greatest."""
    e = last_wins(evals, id_col, pos_col).select(F.col(id_col).alias("__id"), F.col("overall_score").cast("double").alias("__s"))
    j = tools.join(e, tools[id_col] == F.col("__id"), "left")
    return j.withColumns({"overall_score": F.coalesce("__s", F.lit(default)), "failed": F.col("__s").isNull()}).drop("__id", "__s")
