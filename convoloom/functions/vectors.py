"""Cosine similarity over array columns. The three variants differ at the edges and are kept apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("array<double>")


def dot(a: Column | str, b: Column | str) -> Column:
    """Inner product; null if the lengths differ or an element is null."""
    a, b = _c(a), _c(b)
    return F.when(F.size(a) == F.size(b), F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda s, x: s + x * x))


def cosine_plain(a: Column | str, b: Column | str) -> Column:
    """Zero norm gives 0; no clamp; unequal lengths are not defined and give null."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def cosine_graph(a: Column | str, b: Column | str) -> Column:
    """Zero norm, unequal lengths and nulls give 0; no clamp."""
    n = norm(a) * norm(b)
    return F.coalesce(F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n), F.lit(0.0))


def cosine_clamped(a: Column | str, b: Column | str) -> Column:
    """As C1, held between 0 and 1."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine_graph(a, b)))


def has_embedding(a: Column | str) -> Column:
    """a list with elements, zeros included."""
    return F.coalesce(F.size(_c(a)) > 0, F.lit(False))


def usable_embedding(a: Column | str) -> Column:
    """Some element differs from zero."""
    return F.coalesce(F.exists(_c(a), lambda x: x != 0), F.lit(False))
