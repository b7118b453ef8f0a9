"""Entities as JSON and back: nested records, lists, times and enumerations; and what personas are like."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

#: ISO times with six digits of a second, or none; written in the session's time zone and without one.
ISO, ISO_READ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
#: The entities that are read back with checks: schema, enumerations, and fields that have to be there.
ENTITIES = {
    "tool": (schemas.TOOL, {}, ("id", "name")),
    "agent": (schemas.AGENT, {}, ("id", "tools")),
    "task": (schemas.TASK, {"difficulty": schemas.DIFFICULTIES, "task_type": schemas.TASK_TYPES}, ("id", "agent_id")),
    "trajectory": (schemas.TRAJECTORY, {}, ("trajectory_id", "task_id")),
}
PERSONALITY_NOTES = {
    "friendly": "warm and polite, thanks for help and forgives slips",
    "impatient": "wants answers at once and has little time for questions",
    "cautious": "checks every step and asks what might go wrong",
    "casual": "relaxed, talks as to a friend and leaves details open",
}


def to_entity_json(*fields: Column | str, nulls: bool = True) -> Column:
    """A record as JSON text; times in ISO form, enumerations by value; null fields stay unless ``nulls`` is false."""
    return F.to_json(F.struct(*fields), {"timestampFormat": ISO, "ignoreNullFields": str(not nulls).lower()})


def entities_from_json(df: DataFrame, json_col: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the entity ``kind``, rejects with ``error``) of the JSON texts in a column.

    A text that is no object, lacks a required field, or has a value outside of an enumeration is rejected, with the first such error;
    unknown fields are left out, a value of another type reads as null, missing optional fields are null. Rows repeat as they come. Rejects keep all columns
    of ``df``; a column of it that is named ``error`` is replaced.
    """
    schema, enums, required = ENTITIES[kind]
    shape = F.schema_of_variant(F.try_parse_json(json_col))
    read = df.withColumn("__e", F.from_json(json_col, schema, {"timestampFormat": ISO_READ, "mode": "PERMISSIVE"}))
    error = F.when(~F.coalesce(shape.startswith("OBJECT"), F.lit(False)), "no object")
    for f in required:
        error = error.when(F.col("__e")[f].isNull(), f"no {f}")
    for f, values in enums.items():
        error = error.when(F.col("__e")[f].isNotNull() & ~F.col("__e")[f].isin(*values), f"unknown {f}")
    checked = read.withColumn("error", error)
    return checked.filter(F.col("error").isNull()).select("__e.*"), checked.filter(F.col("error").isNotNull()).select(*[c for c in df.columns if c != "error"], "error")


def describe(value: Column, notes: dict[str, str]) -> Column:
    """The note of a value, null for values without one; a lookup in a literal map."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in notes.items() for x in pair]), value)
