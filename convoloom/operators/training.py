"""Training rows: conversion of message lists, with whole conversations rejected for bad calls."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.json_text import one_json


def drop_trailing_user(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The turns without one user message at the end of each conversation."""
    last = turns.groupBy(conv).agg(F.max(turn).alias("__last"))
    return turns.join(last, conv).filter(~((F.col(turn) == F.col("__last")) & (F.col("role") == "user"))).drop("__last")


def observation(message: str) -> str:
    """An observation as text. Of a JSON list each item is a line: objects as JSON without ``metadata``, others as Python prints
    them (text without quotes, ``True``, ``None``). Anything else stays as it is."""
    if not message.lstrip().startswith("["):
        return message
    try:
        items = json.loads(message)
    except ValueError:
        return message
    line = lambda x: json.dumps({k: v for k, v in x.items() if k != "metadata"}, ensure_ascii=False) if isinstance(x, dict) else str(x)
    return "\n".join(map(line, items))


@F.pandas_udf(T.StringType())
def _rewritten(calls: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for call, message in calls:
        yield pd.Series([one_json(m) if c else observation(m) if m is not None else None for c, m in zip(call, message, strict=True)], dtype=object)


def _converted() -> tuple[Column, Column, Column, Column]:
    """Label, value and validity of a turn, and whether its role is known. Only calls and list observations go through Python."""
    call = (F.col("role") == "assistant") & F.coalesce(F.col("recipient") == "execution", F.lit(False))
    label = F.when(call, "function_call").when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise("observation")
    kept = F.coalesce("message", F.lit(""))
    listed = (F.col("role") == "execution") & F.ltrim(kept).startswith("[")
    value = F.coalesce(_rewritten(call, F.when(call | listed, kept)), kept)
    keys = F.json_object_keys(value)
    fine = F.schema_of_variant(F.try_parse_json(value)).startswith("OBJECT") & F.array_contains(keys, "name") & F.array_contains(keys, "arguments")
    return label, value, ~call | F.coalesce(fine, F.lit(False)), F.col("role").isin("user", "assistant", "execution")


def training_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """T10, X6 in long form: (conv, turn, from, value, valid).

    One trailing user message goes; user, assistant and execution become human, gpt and observation; an assistant message to
    execution is a function_call whose value is the JSON found in it, and valid only if that is an object with ``name`` and
    ``arguments``. Other roles go. An observation given as a JSON list becomes its items without ``metadata``, a line each. Null
    messages are empty; repeated turns stay; other columns are not looked at.
    """
    label, value, valid, known = _converted()
    rows = drop_trailing_user(turns.select(conv, turn, "role", "recipient", "message"), conv, turn).filter(known)
    return rows.select(conv, turn, label.alias("from"), value.alias("value"), valid.alias("valid"))


def training_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, conversations) of the conversations without an invalid call. One shuffle; the trailing user message goes
    once a conversation's turns are in order."""
    label, value, valid, known = _converted()
    turn_row = F.struct(F.col(turn).alias("t"), label.alias("from"), value.alias("value"), valid.alias("valid"), known.alias("known"))
    g = turns.groupBy(conv).agg(F.array_sort(F.collect_list(turn_row)).alias("x")).withColumn("last", F.element_at("x", -1)["t"])
    trailing = lambda m: (m["from"] == "human") & (m["t"] == F.col("last"))
    g = g.select(conv, F.filter("x", lambda m: m["known"] & ~trailing(m)).alias("x")).filter((F.size("x") > 0) & F.forall("x", lambda m: m["valid"]))
    return g.select(conv, F.transform("x", lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value"))).alias("conversations"))


def training_table(turns: DataFrame, tools: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, conversations, tools) as ``schemas.TRAINING_ROW``. ``tools`` has (conv, tools), the JSON list of what the
    conversation's agent may call; without a row it is an empty list, and of repeated ones the greatest counts."""
    listed = tools.groupBy(conv).agg(F.max("tools").alias("tools"))
    return training_rows(turns, conv, turn).join(listed, conv, "left").withColumn("tools", F.coalesce("tools", F.lit("[]")))


def conversion_counts(turns: DataFrame, rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Conversations, converted, rejected and the success rate in per cent."""
    total = turns.select(conv).distinct().agg(F.count("*").alias("total"))
    done = rows.agg(F.count("*").alias("converted"))
    t, c = F.col("total"), F.col("converted")
    return total.join(F.broadcast(done)).select("total", "converted", (t - c).alias("rejected"), F.round(F.when(t > 0, 100.0 * c / t).otherwise(0.0), 1).alias("success_rate"))
