"""Repeatable samples, draws and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import md5_key, uniform
from ..session import materialize


#: Rows that one task may rank, and hex digits of a hash that one histogram counts.
MOST_RANKED, DIGITS = 10_000, 4


def hash_sample(df: DataFrame, n: int, key: Column, seed: int = 7) -> DataFrame:
    """L3, L4: exactly ``n`` rows (or all), the same on every run and for every layout: those with the least hashes of ``key``.

    Rows of equal keys go by a hash of the whole row, and equal rows are alike. Beyond ``MOST_RANKED`` rows nothing is sorted: a
    histogram of the first digits of the hashes finds the bucket that the ``n``-th row falls in, and another one of its next digits, until
    that bucket is small enough to be ranked by one task. All rows with lesser hashes pass a filter. Map and variant columns
    do not take part in the order of equal keys.
    """
    if n <= 0:
        return df.limit(0)
    simple = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    whole = F.md5(F.to_json(F.struct(*simple), {"ignoreNullFields": "false"}).cast("binary")) if simple else F.lit("")
    rows, mark = df.withColumn("__h", md5_key(F.lit(seed), key)), F.col("__h")
    if n <= MOST_RANKED:
        return rows.withColumn("__w", whole).orderBy("__h", "__w").limit(n).drop("__h", "__w")
    start, left, digits = "", n, 0
    while True:
        if digits == 32:  # rows of one hash
            mark = F.concat("__h", whole)
        if digits >= 64:  # rows that are all alike
            break
        digits += DIGITS
        inside = rows.filter(mark.startswith(start)) if start else rows
        counts = sorted((r["p"], r["count"]) for r in inside.groupBy(F.substring(mark, 1, digits).alias("p")).count().collect())
        before = 0
        for prefix, count in counts:
            if before + count >= left:
                break
            before += count
        else:
            return df  # no more than n rows
        start, left = prefix, left - before
        if count <= MOST_RANKED:
            break
    less = rows.filter(F.substring(mark, 1, len(start)) < start)
    border = rows.filter(mark.startswith(start)).withColumn("__w", whole).orderBy("__h", "__w").limit(left).drop("__w")
    return less.unionByName(border).drop("__h")


def outcome(key: Column, success: float = 0.85, partial: float = 0.10, seed: int = 7) -> Column:
    """Success, partial_success or failure by a repeatable draw."""
    u = uniform(F.lit(seed), key)
    return F.when(u < success, "success").when(u < success + partial, "partial_success").otherwise("failure")


def quota(target: int, groups: Column | int) -> Column:
    """An even share; the remainder is dropped; no groups give 0."""
    g = F.lit(groups) if isinstance(groups, int) else groups
    return F.when(g > 0, F.floor(F.lit(target) / g)).otherwise(F.lit(0)).cast("long")


def apportion(groups: DataFrame, target: int, group_col: str, weight: Column, cap: Column | int | None = None) -> DataFrame:
    """(group, quota): ``target`` shared out by weight with largest remainders, no group over its cap; what capped groups cannot
    take is shared out again among the others.

    Quotas add up to ``target``, or to the sum of caps if that is less; ties of remainders go to the lesser group. Null or negative
    weights are 0; if all weights are 0 they count as equal. Repeated groups count once, with the greatest weight and cap; a null
    group is a group. Groups are meant to be few (scenarios, domains): each round sorts them in one task.
    """
    most = F.lit(target) if cap is None else F.greatest(F.least(F.coalesce(F.lit(cap) if isinstance(cap, int) else cap, F.lit(target)), F.lit(target)), F.lit(0))
    rows = groups.select(F.col(group_col).alias("group"), F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0)).alias("w"), most.cast("long").alias("cap"))
    rows = rows.groupBy("group").agg(F.max("w").alias("w"), F.max("cap").alias("cap")).withColumn("quota", F.lit(0).cast("long"))
    rows = materialize(rows)
    while True:
        state = rows.agg(F.sum("quota").alias("given"), F.sum(F.when(F.col("quota") < F.col("cap"), F.col("w"))).alias("w"), F.count_if(F.col("quota") < F.col("cap")).alias("open")).first()
        rest = target - (state["given"] or 0)
        if rest <= 0 or not state["open"]:
            return rows.select("group", "quota")
        share = F.when(F.col("quota") < F.col("cap"), F.col("w") * (rest / state["w"]) if state["w"] else F.lit(rest / state["open"])).otherwise(0.0)
        rows = rows.withColumn("share", share).withColumn("whole", F.floor("share"))
        place = F.row_number().over(Window.orderBy((F.col("quota") >= F.col("cap")).cast("int"), F.desc(F.col("share") - F.col("whole")), F.col("group").asc_nulls_first()))
        rows = rows.withColumn("place", place).withColumn("missing", F.lit(rest) - F.sum("whole").over(Window.partitionBy()))
        more = F.when(F.col("quota") < F.col("cap"), F.col("whole") + (F.col("place") <= F.col("missing")).cast("long")).otherwise(0)
        rows = materialize(rows.select("group", "w", "cap", F.least(F.col("quota") + more, F.col("cap")).alias("quota")))


def head(df: DataFrame, n: int, order: Column) -> DataFrame:
    """The first ``n`` rows in an order."""
    return df.orderBy(order).limit(n)
