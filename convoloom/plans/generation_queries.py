"""Queries over the generation stages with the offline provider, and the scoring path from turns to training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import conversation, filters, generation, training
from .conversation_queries import turns
from .registry import query, table


@query()
def generated_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: one domain for every language of documents."""
    domains = [r["lang"] for r in table(spark, sf_dir, "documents").select("lang").distinct().orderBy("lang").collect() if r["lang"]]
    return generation.generate_scenarios(spark, domains, 50)


@query()
def generated_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: ten tools for every nation as a scenario."""
    s = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.col("n_name").alias("description"))
    return generation.generate_tools(s).select("id", "name", F.element_at("scenario_ids", 1).alias("scenario_id"))


@query()
def evaluated_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: every part as a tool."""
    none = F.array().cast("array<struct<name:string,type:string,description:string,required:boolean,enum:array<string>>>")
    t = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), none.alias("parameters"))
    return generation.evaluate_tools(t)


@query()
def generated_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task of each difficulty for every customer as an agent."""
    from ..operators import joins
    from ..schemas import DIFFICULTIES

    a = joins.expand_tasks(table(spark, sf_dir, "customer").select("c_custkey"), DIFFICULTIES)
    return generation.generate_tasks(a.select(F.concat_ws("-", "c_custkey", "difficulty").alias("key"), "difficulty", F.array(F.lit("search"), F.lit("fetch")).alias("tools")))


@query()
def judged_training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefilter, judge, keep what scores above 2, convert."""
    t = turns(spark, sf_dir)
    passed = filters.prefilter_conversations(t).filter("passed").select("conv_id")
    fit = t.join(passed, "conv_id", "left_semi")
    scores = generation.judge(conversation.evaluation_payload(fit), "conv_id")
    good = scores.filter(filters.strict_score(F.col("score"), 2.0)).select("conv_id")
    rows = training.training_rows(fit.join(good, "conv_id", "left_semi"))
    return rows.select("conv_id", F.size("conversations").alias("n_messages"))
