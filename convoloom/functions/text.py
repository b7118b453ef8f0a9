"""Ids, similarity and small text helpers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE_UNITS = {"B": 1, "KB": 1024, "MB": 1024**2, "GB": 1024**3}


def json_string(c: Column) -> Column:
    """The JSON text of a string with non-ASCII letters kept."""
    return F.regexp_extract(F.to_json(F.struct(c.cast("string").alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def canonical_json(fields: dict[str, Column], raw: tuple[str, ...] = ()) -> Column:
    """Sorted keys, ``", "`` and ``": "`` between; ``raw`` fields are put in as they are (numbers)."""
    parts: list[Column] = []
    for i, k in enumerate(sorted(fields)):
        value = fields[k].cast("string") if k in raw else json_string(fields[k])
        parts += [F.lit(("{" if i == 0 else ", ") + f'"{k}": '), F.coalesce(value, F.lit("null"))]
    return F.concat(*parts, F.lit("}"))


def content_id(prefix: str, fields: dict[str, Column], raw: tuple[str, ...] = (), digits: int = 8) -> Column:
    """The prefix and the first digits of the md5 of the canonical JSON; no prefix, no underscore."""
    h = F.substring(F.md5(canonical_json(fields, raw).cast("binary")), 1, digits)
    return F.concat(F.lit(prefix + "_"), h) if prefix else h


def token_estimate(c: Column) -> Column:
    """White-space words times 1.3; an empty or null text has none."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(t == "", F.lit(0.0)).otherwise(F.size(F.split(t, " ")) * 1.3)


def checkpoint_tools(checkpoints: Column) -> Column:
    """The trimmed text before ``(`` of the checkpoints that have one; order and repeats stay."""
    return F.transform(F.filter(checkpoints, lambda c: c.contains("(")), lambda c: F.trim(F.substring_index(c, "(", 1)))


@F.pandas_udf(T.DoubleType())
def text_similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Ratcliff-Obershelp ratio of the lower-cased texts; 0 if one is empty or null."""
    for a, b in batches:
        yield pd.Series([SequenceMatcher(None, x.lower(), y.lower()).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def byte_size(text: str) -> int:
    """X11: ``10MB`` as bytes."""
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([KMG]?B)?\s*", text.upper())
    if not m:
        raise ValueError(f"not a size: {text}")
    return int(float(m[1]) * SIZE_UNITS[m[2] or "B"])


def uniform(*key: Column) -> Column:
    """A repeatable number in [0, 1) for a key: the first 13 hex digits of its md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[k.cast("string") for k in key]).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def md5_key(*key: Column) -> Column:
    """A repeatable order for samples."""
    return F.md5(F.concat_ws(":", *[k.cast("string") for k in key]).cast("binary"))
