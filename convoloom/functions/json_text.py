"""JSON inside free text: tool-call tests, detection, extraction."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What delimits JSON in a message. One nesting level for bare objects and lists.
JSON_FENCE = r"(?s)```json\s*(.*?)\s*```"
ANY_FENCE = r"(?s)```\s*(.*?)\s*```"
BARE_OBJECT = r"\{[^{}]*(?:\{[^{}]*\}[^{}]*)*\}"
BARE_LIST = r"\[[^\[\]]*(?:\[[^\[\]]*\][^\[\]]*)*\]"


def strip(s: Column) -> Column:
    """Trims all Unicode white space."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def is_tool_call(s: Column) -> Column:
    """F8: an object with a non-blank string ``name`` and, if present, an object ``arguments``."""
    v = F.try_parse_json(s)
    whole = F.schema_of_variant(v)
    name = F.schema_of_variant(F.try_variant_get(v, "$.name", "variant"))
    args = F.schema_of_variant(F.try_variant_get(v, "$.arguments", "variant"))
    return F.coalesce(
        whole.startswith("OBJECT") & (name == "STRING") & (strip(F.try_variant_get(v, "$.name", "string")) != "") & F.coalesce(args.startswith("OBJECT"), F.lit(True)),
        F.lit(False),
    )


def contains_tool_call(s: Column) -> Column:
    """The first json fence, the first fence, any bare object, or the whole text with white space joined is a tool call."""
    bare = F.regexp_extract_all(s, F.lit(BARE_OBJECT), F.lit(0))
    tests = [
        is_tool_call(strip(F.regexp_extract(s, JSON_FENCE, 1))),
        is_tool_call(strip(F.regexp_extract(s, ANY_FENCE, 1))),
        F.exists(bare, is_tool_call),
        is_tool_call(F.regexp_replace(strip(s), r"\s+", " ")),
    ]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return F.coalesce(out, F.lit(False))


def extract_tool_calls(s: Column) -> Column:
    """The JSON of all tool calls, in the order json fences, other fences, bare objects, bare lists, whole text; each
    distinct call (by its normalised JSON) once. Lists give their items."""
    rest = F.regexp_replace(F.regexp_replace(s, r"(?s)```json.*?```", " "), r"(?s)```.*?```", " ")
    found = F.concat(
        F.transform(F.regexp_extract_all(s, F.lit(JSON_FENCE), F.lit(1)), strip),
        F.transform(F.regexp_extract_all(s, F.lit(ANY_FENCE), F.lit(1)), strip),
        F.regexp_extract_all(rest, F.lit(BARE_OBJECT), F.lit(0)),
        F.regexp_extract_all(rest, F.lit(BARE_LIST), F.lit(0)),
        F.array(F.regexp_replace(strip(rest), r"\s+", " ")),
    )
    items = lambda c: F.when(
        F.schema_of_variant(F.try_parse_json(c)).startswith("ARRAY"),
        F.coalesce(F.transform(F.try_variant_get(F.try_parse_json(c), "$", "array<variant>"), lambda v: F.to_json(v)), F.array().cast("array<string>")),
    ).otherwise(F.array(F.coalesce(F.to_json(F.try_parse_json(c)), F.lit(""))))
    return F.array_distinct(F.filter(F.flatten(F.transform(found, items)), is_tool_call))


def parse_llm_json(s: Column) -> Column:
    """The text itself if it is JSON, else its first json fence, else its first bare fence; null if none parses."""
    fence = lambda p: F.try_parse_json(strip(F.nullif(F.regexp_extract(s, p, 1), F.lit(""))))
    first = F.when(s.contains("```json"), fence(JSON_FENCE)).otherwise(fence(ANY_FENCE))
    return F.to_json(F.coalesce(F.try_parse_json(strip(s)), first))


#: What matters between braces: escaped characters, quotes and braces.
TOKEN = re.compile(r'\\.|["{}]', re.S)


def closing_braces(text: str) -> dict[int, int]:
    """Where the object of each open brace ends, for braces that close, from one scan.

    Seen from a brace, a later one stands in a string if an odd number of quotes lies between. So braces fall into two kinds, by
    the quotes before them, and those of a kind close each other whatever the other kind does: two stacks of open places.
    """
    waiting: tuple[list[int], list[int]] = ([], [])
    ends, kind = {}, 0
    for m in TOKEN.finditer(text):
        c = m[0]
        if c == '"':
            kind ^= 1
        elif c == "{":
            waiting[kind].append(m.start())
        elif c == "}" and waiting[kind]:
            ends[waiting[kind].pop()] = m.end()
    return ends


def outer_objects(text: str) -> Iterator[str]:
    """Balanced stretches in braces, left to right, none inside another; an open brace that never closes hides nothing."""
    ends = closing_braces(text)
    at = text.find("{")
    while at >= 0:
        end = ends.get(at)
        if end:
            yield text[at:end]
        at = text.find("{", end or at + 1)


def _parsed(s: str) -> tuple[bool, object]:
    """Whether a text is JSON, and its value; what is nested too deep to be read is not."""
    try:
        return True, json.loads(s)
    except (ValueError, RecursionError):
        return False, None


def one_json(content: str | None) -> str | None:
    """The JSON that a reply most likely means. That is the first fence which holds JSON, those marked as such before others; or
    all that stands outside of fences; or, of the objects in it, the first with a ``name``, else the first. Otherwise the text."""
    if content is None:
        return None
    text = content.strip()
    if "```" not in text and _parsed(text)[0]:  # no fence, and all of it is JSON
        return text
    outside = re.sub(r"(?s)```.*?```", " ", re.sub(r"(?s)```json.*?```", " ", text))
    whole = chain(re.findall(JSON_FENCE, text), re.findall(ANY_FENCE, text), [outside])
    for part in map(str.strip, whole):
        if part and _parsed(part)[0]:
            return part
    any_object = None
    for part in outer_objects(outside):
        ok, value = _parsed(part)
        if ok and "name" in value:
            return part
        if ok and any_object is None:
            any_object = part
    return any_object or text


@F.pandas_udf(T.StringType())
def balanced_json(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """``one_json`` over a column, in Arrow batches."""
    for s in batches:
        yield s.map(one_json, na_action="ignore")
