"""Contiguous shards of near equal bytes, from global prefix sums over per-partition totals (built-in functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Fewest sub-ranges of the checksum that an id with very many rows is split into.
HOT_SPLITS = 32
#: Copies of one row that a single generator call makes.
COPIES_A_CHUNK = 8192


def _ordinal(bounds: list[int], x: Column) -> Column:
    """How many of the sorted ``bounds`` are below ``x``, by binary search in the expression."""
    if not bounds:
        return F.lit(0)
    table = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps, step = [], 1
    while step <= len(bounds):
        steps.insert(0, step)
        step *= 2
    at = lambda i: F.element_at(table, i)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, s: F.when((low + s <= len(bounds)) & (at(F.least(low + s, F.lit(len(bounds)))) < x), low + s).otherwise(low),
    )


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", rows_a_bucket: int = 200_000) -> DataFrame:
    """Give every row a shard and a gapless slot in it, in the order of (id, checksum, size).

    Size is the UTF-8 length of the text plus 1 (null text: 1, checksum 0). A row belongs to the shard in which the middle of
    its byte range falls, so shards differ from equal by at most one row's size. Rows with null ids come first. Rows that agree
    in id, size and checksum are counted before any shuffle of single rows and dealt out again in chunks, and an id that fills
    more than one quantile is split by as many ranges of its checksum as its rows need, so neither copies nor one hot id meet in one task.
    An empty table gives no rows; other columns are not looked at.
    """
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    groups = materialize(docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), crc.alias("crc")).groupBy("doc_id", "size", "crc").agg(F.count("*").alias("n")))

    seen = groups.agg(F.count("*").alias("groups"), F.sum(F.col("n") * F.col("size")).alias("bytes")).first()
    n_buckets = int(min(8192, max(64, seen["groups"] // rows_a_bucket)))
    cuts = groups.agg(F.percentile_approx("doc_id", [i / n_buckets for i in range(1, n_buckets)], 20 * n_buckets).alias("q")).first()["q"] or []
    hot = sorted({a for a, b in zip(cuts, cuts[1:], strict=False) if a == b})
    # A hot id gets a range of its own: one bound just below it and one at it.
    bounds = sorted({*cuts, *[h - 1 for h in hot]})
    is_hot = F.col("doc_id").isNull() | (F.col("doc_id").isin(hot) if hot else F.lit(False))
    largest = groups.filter(is_hot).groupBy("doc_id").count().agg(F.max("count")).first()[0] or 0
    splits = max(HOT_SPLITS, -(-largest // rows_a_bucket))
    placed = groups.withColumns(
        {
            "bucket": F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_ordinal(bounds, F.col("doc_id"))),
            "part": F.when(is_hot, F.floor(F.col("crc") * splits / F.lit(float(1 << 32))).cast("int")).otherwise(F.lit(0)),
            "b": F.col("n") * F.col("size"),
        }
    )
    # One row per bucket and part: a few thousand, and one for each rows_a_bucket rows of hot ids.
    before = Window.orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("bucket", "part")
        .agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
        .select("bucket", "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    )
    within = Window.partitionBy("bucket", "part").orderBy("doc_id", "crc", "size").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.join(F.broadcast(offsets), ["bucket", "part"])
        .withColumns({"b0": F.col("b0") + F.coalesce(F.sum("b").over(within), F.lit(0)), "n0": F.col("n0") + F.coalesce(F.sum("n").over(within), F.lit(0))})
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES_A_CHUNK}"))))
        .repartition("bucket", "part", "chunk", "crc")
        .withColumn("i", F.explode(F.sequence(F.col("chunk") * COPIES_A_CHUNK, F.least(F.col("n"), (F.col("chunk") + 1) * COPIES_A_CHUNK) - 1)))
    )
    total = int(seen["bytes"] or 1)
    rows = runs.select(
        "doc_id", "size", "crc", (F.col("n0") + F.col("i")).alias("at"),
        F.expr(f"cast(least((2 * (b0 + i * size) + size) * {n_shards} div {2 * total}, {n_shards - 1}) as int)").alias("shard"),
    )
    first = rows.groupBy("shard").agg(F.min("at").alias("first"))
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("at") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
