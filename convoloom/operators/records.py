"""Shaping of records: normalised scenarios and tools, schemas for prompts, tasks, personas, merges."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import checkpoint_tools, content_id, uniform
from ..schemas import DIFFICULTIES, TASK_TYPES
from ..session import materialize
from ..sources.files import last_wins

#: Schemas that a partition of agent records takes, so that a task's memory does not grow with the tables.
SCHEMAS_A_PARTITION = 500_000
# The personas that are drawn from.
PERSONALITIES = ("friendly", "impatient", "cautious", "casual")
STYLES = ("formal", "informal", "life_oriented")


def normalize_scenario(name: Column, description: Column, domain: Column, context: Column, users: Column) -> Column:
    """An emitted scenario; missing texts are empty, missing users an empty list, the id comes from name and domain."""
    e = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        content_id("scenario", {"name": e(name), "domain": e(domain)}).alias("id"), e(name).alias("name"), e(description).alias("description"), e(domain).alias("domain"),
        e(context).alias("context"), F.coalesce(users, F.array().cast("array<string>")).alias("target_users"),
    )


def normalize_tool(name: Column, description: Column, parameters: Column, return_type: Column, scenario_id: Column) -> Column:
    """P5: an emitted tool; parameters get their defaults (type string, required true) and the return type ``object``."""
    e = lambda c: F.coalesce(c, F.lit(""))
    full = F.transform(
        F.coalesce(parameters, F.array().cast("array<struct<name:string,type:string,description:string,required:boolean,enum:array<string>>>")),
        lambda p: F.struct(e(p["name"]).alias("name"), F.coalesce(p["type"], F.lit("string")).alias("type"), e(p["description"]).alias("description"), F.coalesce(p["required"], F.lit(True)).alias("required"), p["enum"].alias("enum")),
    )
    return F.struct(
        content_id("tool", {"name": e(name), "scenario": e(scenario_id)}).alias("id"), e(name).alias("name"), e(description).alias("description"), full.alias("parameters"),
        F.coalesce(return_type, F.lit("object")).alias("return_type"), F.array(scenario_id).alias("scenario_ids"),
    )


def function_schema(name: Column, description: Column, parameters: Column, required_default: bool = True) -> Column:
    """P3 (P4 with ``required_default`` false): the function-call schema as JSON; an empty enum is left out,
    a missing type is ``string``, and a missing name or description empty."""
    prop = lambda p: F.to_json(F.struct(F.coalesce(p["type"], F.lit("string")).alias("type"), F.coalesce(p["description"], F.lit("")).alias("description"), F.when(F.size(p["enum"]) > 0, p["enum"]).alias("enum")))
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    body = F.array_join(F.transform(parameters, lambda p: F.concat(quoted(F.coalesce(p["name"], F.lit(""))), F.lit(":"), prop(p))), ",")
    needed = F.transform(F.filter(parameters, lambda p: F.coalesce(p["required"], F.lit(required_default))), lambda p: p["name"])
    return F.concat(
        F.lit('{"name":'), quoted(F.coalesce(name, F.lit(""))), F.lit(',"description":'), quoted(F.coalesce(description, F.lit(""))),
        F.lit(',"parameters":{"type":"object","properties":{'), body, F.lit('},"required":'), F.to_json(needed), F.lit("}}"),
    )


def tools_block(tools: Column) -> Column:
    """The tools of an agent as text for a prompt; entries are parted by a literal backslash and n."""
    return F.array_join(F.transform(tools, lambda t: F.concat(F.lit("- "), t["name"], F.lit(": "), t["description"])), "\\n")


def expected_tools(checkpoints: Column) -> Column:
    """See ``checkpoint_tools``."""
    return checkpoint_tools(checkpoints)


def fill(template: str, **values: Column) -> Column:
    """A prompt from a template with ``{name}`` places."""
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def agent_records(combinations: DataFrame, tools: DataFrame, template: str, id_col: str = "id", tools_col: str = "tool_ids") -> DataFrame:
    """(id, system_prompt, tools) of every combination with a tool. The id follows from the combination's; the prompt is
    ``template`` with the schemas of its known tools (id, name, description, parameters), in order and an empty line apart, at
    ``{tools_list}``. Combinations without tools, null lists too, go; unknown tools stay in the list only; repeated tool ids
    count once in ``tools``' table, by the greatest row. Combinations are written to the checkpoint folder and counted once, and
    dealt to partitions of about SCHEMAS_A_PARTITION schemas: schemas shrink so well in a shuffle that its bytes tell little."""
    schemas = last_wins(tools, "id").select(F.col("id").alias("__tool"), function_schema(F.col("name"), F.col("description"), F.col("parameters"), False).alias("__schema"))
    some = materialize(combinations.filter(F.size(tools_col) > 0).select(F.col(id_col).alias("__c"), F.col(tools_col).alias("tools")))
    n = max(1, ceil((some.agg(F.sum(F.size("tools"))).first()[0] or 0) / SCHEMAS_A_PARTITION))
    parts = some.select("__c", F.posexplode("tools").alias("__pos", "__tool")).join(schemas, "__tool").repartition(n, "__c")
    lists = parts.groupBy("__c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__schema"))), lambda x: x["__schema"]), "\n\n").alias("__list"))
    found = some.repartition(n, "__c").join(lists, "__c", "left")
    return found.select(content_id("agent", {"combination": F.col("__c").cast("string")}).alias("id"), fill(template, tools_list=F.col("__list")).alias("system_prompt"), "tools")


def name_use_pairs(df: DataFrame, name_col: str, uses_col: str) -> DataFrame:
    """P10: ``name+use`` for every use."""
    return df.select(F.col(name_col).alias("n"), F.explode(uses_col).alias("u")).select(F.concat_ws("+", "n", "u").alias("pair"))


def draw_persona(key: Column, seed: int = 7) -> Column:
    """A repeatable even draw of personality and style for a key, with a name."""
    pick = lambda values, tag: F.element_at(F.array(*[F.lit(v) for v in values]), F.floor(uniform(F.lit(seed), key, F.lit(tag)) * len(values)).cast("int") + 1)
    p, s = pick(PERSONALITIES, "personality"), pick(STYLES, "style")
    return F.struct(F.concat_ws("_", p, s, F.lit("user")).alias("name"), p.alias("personality_type"), s.alias("style_type"))


def enum_or(c: Column, allowed: tuple[str, ...], default: str) -> Column:
    """An allowed value, or the default for anything else."""
    return F.when(c.isin(*allowed), c).otherwise(F.lit(default))


def task_fields(difficulty: Column, task_type: Column) -> Column:
    """Unknown difficulty becomes medium, unknown type multi_turn."""
    return F.struct(enum_or(difficulty, DIFFICULTIES, "medium").alias("difficulty"), enum_or(task_type, TASK_TYPES, "multi_turn").alias("task_type"))


def merge_batches(*batches: DataFrame) -> DataFrame:
    """All rows of all batches; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def combination_record(scenario: Column, tools: Column, method: Column) -> Column:
    """A record of a tool combination; its id depends on scenario and sorted tools only, so runs repeat."""
    s = F.array_sort(tools)
    return F.struct(content_id("combo", {"scenario": scenario, "tools": F.array_join(s, ",")}).alias("id"), scenario.alias("scenario_id"), s.alias("tool_ids"), method.alias("generation_method"), F.size(s).alias("tool_count"))
