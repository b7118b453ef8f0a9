"""Quality filters and validation. Every rule is a column or a filter over one; nothing here shuffles except the joins of F1 and F12."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FINISH_MARK
from ..sources.files import last_wins


def filter_tools_by_score(tools: DataFrame, evals: DataFrame, threshold: float = 4.0, id_col: str = "id", score_col: str = "overall_score", pos_col: str | None = None) -> DataFrame:
    """Tools whose evaluation reaches the threshold (``>=``) or that have none; of repeated evaluations the last
    by ``pos_col`` counts, and without that the greatest."""
    e = last_wins(evals, id_col, pos_col)
    e = e.select(F.col(id_col).alias("__id"), F.col(score_col).cast("double").alias("score"))
    joined = tools.join(e, tools[id_col] == F.col("__id"), "left").drop("__id")
    return joined.filter(F.col("score").isNull() | (F.col("score") >= threshold))


def tool_filter_counts(tools: DataFrame, evals: DataFrame, threshold: float = 4.0, id_col: str = "id", score_col: str = "overall_score", pos_col: str | None = None) -> DataFrame:
    """The counters of F1 in one row, repeated evaluations as there."""
    e = last_wins(evals, id_col, pos_col).select(F.col(id_col).alias("__id"), F.col(score_col).cast("double").alias("score"))
    j = tools.join(e, tools[id_col] == F.col("__id"), "left")
    s = F.col("score")
    return j.agg(
        F.count("*").alias("total"), F.count("score").alias("evaluated"), F.count_if(s >= threshold).alias("high_quality"),
        F.count_if(s < threshold).alias("filtered"), F.count_if(s.isNull()).alias("no_evaluation"),
    )


def strict_score(score: Column, threshold: float = 4.0) -> Column:
    """strictly above; null and NaN fail (NaN sorts above all numbers in Spark, so it is named)."""
    return F.coalesce((score > threshold) & ~F.isnan(score), F.lit(False))


def strict_variant_score(raw: Column, threshold: float = 4.0) -> Column:
    """F2 over a free-form value: numbers and booleans (as 1 and 0) count, text does not."""
    kind = F.schema_of_variant(raw)
    number = F.when(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL") | (kind == "BOOLEAN"), F.try_variant_get(raw, "$", "double"))
    return strict_score(number, threshold)


def default_score(score: Column, threshold: float = 3.0, missing: float = 5.0) -> Column:
    """a missing score counts as ``missing``; ``>=``."""
    return F.coalesce(score, F.lit(missing)) >= threshold


def passed(score: Column, threshold: float = 4.0) -> Column:
    """Whether a score passes; null does not."""
    return F.coalesce(score >= threshold, F.lit(False))


def valid_scenario(name: Column, description: Column, context: Column) -> Column:
    """all three are there and not empty, the description has 10 characters or more."""
    there = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    return there(name) & there(description) & there(context) & (F.length(description) >= 10)


def valid_tool(name: Column, description: Column, parameters_json: Column) -> Column:
    """name and description are there; ``parameters``, if given, is a list of objects with name, type and description."""
    v = F.try_parse_json(parameters_json)
    items = F.try_variant_get(v, "$", "array<variant>")
    has = lambda x: F.forall(F.array(*[F.lit(k) for k in ("name", "type", "description")]), lambda k: F.array_contains(F.json_object_keys(F.to_json(x)), k))
    fine = F.schema_of_variant(v).startswith("ARRAY") & F.forall(items, lambda x: F.coalesce(F.schema_of_variant(x).startswith("OBJECT"), F.lit(False)) & F.coalesce(has(x), F.lit(False)))
    there = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))
    return there(name) & there(description) & (parameters_json.isNull() | F.coalesce(fine, F.lit(False)))


def valid_task(title: Column, description: Column, difficulty: Column, checkpoints: Column, criteria: Column, available: Column) -> Column:
    """all fields are there, some checkpoint exists, and every tool that a checkpoint calls is available."""
    used = F.transform(F.filter(checkpoints, lambda c: c.contains("(")), lambda c: F.trim(F.substring_index(c, "(", 1)))
    return title.isNotNull() & description.isNotNull() & difficulty.isNotNull() & criteria.isNotNull() & F.coalesce(F.size(checkpoints) > 0, F.lit(False)) & F.coalesce(F.size(F.array_except(used, available)) == 0, F.lit(False))


def prefilter_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "speaker", message: str = "message") -> DataFrame:
    """for each conversation whether it has user and agent turns and ends with the user's finish mark (any case)."""
    last = F.max_by(F.struct(F.col(speaker).alias("s"), F.col(message).alias("m")), turn)
    g = turns.groupBy(conv).agg(F.bool_or(F.col(speaker) == "user").alias("u"), F.bool_or(F.col(speaker) == "agent").alias("a"), last.alias("last"), F.count("*").alias("n_turns"))
    ok = F.col("u") & F.col("a") & (F.col("last.s") == "user") & F.lower("last.m").contains(FINISH_MARK)
    return g.select(conv, "n_turns", F.coalesce(ok, F.lit(False)).alias("passed"))


def valid_score(score: Column, low: float = 0.0, high: float = 5.0) -> Column:
    """there and between the bounds."""
    return F.coalesce(score.between(low, high) & ~F.isnan(score), F.lit(False))


def check_arguments(args: Column, params: list[tuple[str, str, bool]]) -> Column:
    """null if a JSON object of arguments is valid, else the first fault. ``params``: (name, type, required).

    Missing required names come first. An integer parameter takes what Python's int() takes: whole-number text, numbers (cut
    towards zero) and booleans; number and float take what float() takes. Other types are not looked at."""
    v = F.try_parse_json(args)
    keys = F.coalesce(F.json_object_keys(args), F.array().cast("array<string>"))
    missing = F.array_except(F.array(*[F.lit(n) for n, _, r in params if r]).cast("array<string>"), keys)
    out = F.when(F.size(missing) > 0, F.concat(F.lit("Missing required parameters: "), F.array_join(missing, ", ")))
    for name, kind, _ in params:
        if kind not in ("integer", "number", "float"):
            continue
        got = F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))
        text = F.try_variant_get(v, f"$.{name}", "string")
        plain = got.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | got.startswith("DECIMAL")
        pattern = r"^\s*[+-]?[0-9]+\s*$" if kind == "integer" else r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
        fine = plain | ((got == "STRING") & text.rlike(pattern))
        word = "an integer" if kind == "integer" else "a number"
        out = out.when(F.array_contains(keys, name) & ~F.coalesce(fine, F.lit(False)), F.lit(f"Parameter '{name}' should be {word}"))
    return out


def check_call(args: Column, params: Column) -> Column:
    """F10 for calls of different tools: a struct of ``fault`` (null if the call is valid) and ``values``, the arguments by name.

    ``params`` is the tool's own list of structs with ``name``, ``type`` and ``required`` (null: true). Missing names come first,
    then the first wrong type in the order of the list, as in ``check_arguments``. In ``values`` integers are cut towards zero,
    numbers are floating and all else is text or JSON; it is null for a call with a fault. Null or unreadable arguments are an
    empty object, a null list has no parameters."""
    given = F.coalesce(F.try_variant_get(F.try_parse_json(args), "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    params = F.coalesce(params, F.array().cast("array<struct<name:string,type:string,required:boolean>>"))
    names = F.map_keys(given)
    missing = F.transform(F.filter(params, lambda p: F.coalesce(p["required"], F.lit(True)) & ~F.array_contains(names, p["name"])), lambda p: p["name"])

    def fault(p: Column) -> Column:
        got, text = F.schema_of_variant(given[p["name"]]), F.try_variant_get(given[p["name"]], "$", "string")
        plain = got.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | got.startswith("DECIMAL")
        whole = plain | ((got == "STRING") & text.rlike(r"^\s*[+-]?[0-9]+\s*$"))
        number = plain | ((got == "STRING") & text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"))
        there = F.array_contains(names, p["name"])
        say = lambda word: F.concat(F.lit("Parameter '"), p["name"], F.lit(f"' should be {word}"))
        return F.when(there & (p["type"] == "integer") & ~F.coalesce(whole, F.lit(False)), say("an integer")).when(there & p["type"].isin("number", "float") & ~F.coalesce(number, F.lit(False)), say("a number"))

    wrong = F.filter(F.transform(params, fault), lambda x: x.isNotNull())
    first = F.when(F.size(missing) > 0, F.concat(F.lit("Missing required parameters: "), F.array_join(missing, ", "))).otherwise(F.try_element_at(wrong, F.lit(1)))
    kinds = F.map_from_entries(F.transform(F.array_distinct(F.transform(params, lambda p: p["name"])), lambda n: F.struct(n, F.element_at(F.filter(params, lambda p: p["name"] == n), -1)["type"])))

    def value(name: Column, v: Column) -> Column:
        kind, text = kinds[name], F.trim(F.try_variant_get(v, "$", "string"))
        number = F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(v, "$", "int").cast("double")).otherwise(text.try_cast("double"))
        whole = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("decimal(38,0)")).otherwise(F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("decimal(38,0)"))
        return F.when(kind == "integer", whole.cast("string")).when(kind.isin("number", "float"), number.cast("string")).otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))

    return F.struct(first.alias("fault"), F.when(first.isNull(), F.transform_values(given, value)).alias("values"))


def known_tools(agents: DataFrame, tools: DataFrame, least: int = 2, id_col: str = "id", tools_col: str = "tools") -> DataFrame:
    """agents with their tool lists cut down to known tools, in order; those with fewer than ``least`` go."""
    pairs = agents.select(F.col(id_col).alias("__a"), F.posexplode(tools_col).alias("__pos", "__tool"))
    known = pairs.join(tools.select(F.col("id").alias("__tool")).distinct(), "__tool", "left_semi")
    lists = known.groupBy("__a").agg(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "__tool"))), lambda x: x["__tool"]).alias("__known"))
    return agents.join(lists, agents[id_col] == F.col("__a")).filter(F.size("__known") >= least).withColumn(tools_col, F.col("__known")).drop("__a", "__known")


def groups_of_size(df: DataFrame, group_col: str, least: int = 3) -> DataFrame:
    """groups with at least ``least`` rows, with their sizes; null groups do not count."""
    return df.filter(F.col(group_col).isNotNull()).groupBy(group_col).agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """rows with a value in every column."""
    return df.dropna(subset=list(cols))
