"""Joins between tasks, agents, tools and evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import last_wins


def match_tasks(tasks: DataFrame, agents: DataFrame, agent_tools: DataFrame, tools: DataFrame, least: int = 2) -> DataFrame:
    """Tasks (task_id, agent_id) whose agent (agent_id) is known and of whose tools (task_id, pos, tool_id) at least ``least``
    are known (tool_id, name). Gives (task_id, agent_id, n_tools, names); the names are those of the tools, each once, by the
    position of its last tool."""
    known = agent_tools.join(tools.select("tool_id", "name"), "tool_id")
    named = known.groupBy("task_id", "name").agg(F.max("pos").alias("pos"), F.collect_set("tool_id").alias("ids"))
    lists = named.groupBy("task_id").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("x"), F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
    lists = lists.filter(F.size("ids") >= least).select("task_id", F.size("ids").cast("long").alias("n_tools"), F.transform("x", lambda x: x["name"]).alias("names"))
    return tasks.join(agents.select("agent_id"), "agent_id", "left_semi").join(lists, "task_id").select("task_id", "agent_id", "n_tools", "names")


def pending(tasks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Tasks without a trajectory yet."""
    return tasks.join(done.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, key: str, pos_col: str | None = None) -> DataFrame:
    """Old rows with the new values of those keys that have some; keys that are only new are not added. Of repeated new keys
    the last by ``pos_col`` counts, and without that the greatest row; null keys meet nothing."""
    new = last_wins(new, key, pos_col)
    other = [c for c in old.columns if c != key]
    fresh = new.select(F.col(key).alias("__k"), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in other if c in new.columns])
    j = old.join(fresh, old[key] == F.col("__k"), "left")
    return j.select(key, *[F.when(F.col("__hit"), F.coalesce(F.col(f"__{c}"), old[c])).otherwise(old[c]).alias(c) if c in new.columns else old[c] for c in other])


def expand_tasks(agents: DataFrame, difficulties: tuple[str, ...], tasks_each: int = 1) -> DataFrame:
    """One row for every agent, difficulty and task number; the lists are literals, so nothing is joined."""
    return agents.withColumn("difficulty", F.explode(F.array(*[F.lit(d) for d in difficulties]))).withColumn("task_index", F.explode(F.sequence(F.lit(0), F.lit(tasks_each - 1))))


def lookup_tools(calls: DataFrame, registry: DataFrame, name_col: str = "tool_name") -> DataFrame:
    """Calls with ``found`` and, where the tool is not registered, ``error_type`` tool_not_found."""
    r = registry.select(F.col("name").alias("__n")).distinct()
    j = calls.join(r, F.col(name_col) == F.col("__n"), "left")
    return j.withColumns({"found": F.col("__n").isNotNull(), "error_type": F.when(F.col("__n").isNull(), F.lit("tool_not_found"))}).drop("__n")


def ordered_tools_json(items: DataFrame, owner: str, pos: list[str], tool_json: Column) -> DataFrame:
    """The tools of every owner as one JSON list in order."""
    return items.groupBy(owner).agg(F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*pos, tool_json.alias("__j")))), lambda x: x["__j"]), ", "), F.lit("]")).alias("tools"))


def dedup_combinations(combos: DataFrame, tools_col: str, pos_col: str) -> DataFrame:
    """D3: the first combination of each set of tools, all groups together; of equal positions the least row (maps and variants aside)."""
    simple = [F.col(f"`{c}`") for c, kind in combos.dtypes if "map<" not in kind and "variant" not in kind]
    order = Window.partitionBy(F.array_sort(F.col(tools_col))).orderBy(pos_col, *simple)
    return combos.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") == 1).drop("__r")


def primary_scenario(df: DataFrame, ids_col: str = "scenario_ids") -> DataFrame:
    """Rows with their first scenario; rows without any go."""
    return df.filter(F.size(ids_col) > 0).withColumn("scenario_id", F.element_at(ids_col, 1))
