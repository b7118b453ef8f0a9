"""Seeded walks over weighted graphs and the tool combinations made of them; no neighbour list is ever held whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import uniform
from ..session import materialize
from .graph import neighbors_topk, undirected

#: About how many neighbours stand in a block, and below how many hubs their table is sent to all tasks.
BLOCK, MOST_HUBS = 2000, 100_000


class Choices:
    """Weighted choices of every key, in blocks of about ``block`` items with cumulative weights, and blocks of blocks above them.

    A draw goes down from the top block, one keyed lookup a level, so a key with a million items costs a draw two lookups in
    blocks of a few thousand rows. A key with up to ``block`` items has one block. Items are dealt to blocks by hash; keys whose weights are all 0
    choose evenly. Null and negative weights count as 0.
    """

    def __init__(self, items: DataFrame, key: str, item: str, weight: str, block: int = BLOCK):
        rows = items.select(F.col(key).alias("key"), F.col(item).alias("item"), F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("w"))
        sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("w").alias("total"))
        special = materialize(sizes.filter((F.col("n") > block) | (F.col("total") == 0)))
        most = special.agg(F.max("n")).first()[0] or 0
        hubs = F.broadcast(special) if special.count() <= MOST_HUBS else special
        rows = rows.join(hubs, "key", "left").withColumn("w", F.when(F.col("total") == 0, 1.0).otherwise(F.col("w")))
        self.levels: list[DataFrame] = []
        n = F.greatest(F.ceil(F.coalesce("n", F.lit(1)) / block), F.lit(1))
        while True:
            dealt = rows.withColumn("n", n).withColumn("block", F.pmod(F.xxhash64("item", F.lit(len(self.levels))), F.col("n")))
            line = Window.partitionBy("key", "block").orderBy("item").rowsBetween(Window.unboundedPreceding, 0)
            upto = F.struct(F.sum("w").over(line).alias("upto"), F.col("item").alias("item"), F.col("w").alias("w"))
            whole = dealt.select("key", "block", "n", upto.alias("x")).groupBy("key", "block", "n").agg(F.array_sort(F.collect_list("x")).alias("items"))
            level = materialize(whole.withColumn("sum", F.element_at("items", -1)["upto"]))
            self.levels.append(level.select("key", "block", "items", "sum"))
            if most <= block:
                return
            most = -(-most // block)
            rows = level.filter("n > 1").select("key", F.col("block").alias("item"), F.col("sum").alias("w"), "n")
            n = F.greatest(F.ceil(F.col("n") / block), F.lit(1))

    def draw(self, rows: DataFrame, key: str, draw: Column, out: str) -> DataFrame:
        """``rows`` with an item of the row's key chosen by a draw from [0, 1); null for keys without items."""
        state = rows.withColumns({"__u": draw, "__b": F.lit(0).cast("long"), "__x": F.lit(None).cast("double")})
        for i in range(len(self.levels) - 1, -1, -1):
            level = self.levels[i].select(F.col("key").alias("__k"), F.col("block").alias("__kb"), F.col("items").alias("__items"), F.col("sum").alias("__sum"))
            state = state.join(level, (F.col(key) == F.col("__k")) & (F.col("__b") == F.col("__kb")), "left")
            x = F.coalesce("__x", F.col("__u") * F.col("__sum"))
            got = F.coalesce(F.get(F.filter("__items", lambda e: (e["upto"] > x) & (e["w"] > 0)), F.lit(0)), F.element_at(F.filter("__items", lambda e: e["w"] > 0), -1))
            state = state.withColumn("__got", got)
            if i:
                state = state.withColumns({"__x": F.when(F.col("__k").isNotNull(), F.greatest(x - F.col("__got.upto") + F.col("__got.w"), F.lit(0.0))), "__b": F.coalesce("__got.item", "__b")})
            else:
                state = state.withColumn(out, F.col("__got.item"))
            state = state.drop("__k", "__kb", "__items", "__sum", "__got")
        return state.drop("__u", "__b", "__x")


def random_walks(
    starts: DataFrame, edges: DataFrame, size: Column, walk_length: int = 6, restart: float = 0.15, seed: int = 7, id_col: str = "walk", node_col: str = "start", block: int = BLOCK
) -> DataFrame:
    """For each walk its nodes in the order of the first visit, without the start.

    ``size`` is how many nodes are wanted, the start counting towards it; a walk makes up to ``walk_length`` steps for each of them.
    A step goes to a neighbour drawn by weight (evenly if all weights are 0), or back to the start with probability ``restart`` or
    from a node without neighbours. Draws are hashes of seed, walk and step, so a repeated run gives the same walks. Walk ids
    have to be distinct; a null start has no neighbours; edges with a null end are left out; parallel edges add up.
    """
    near = Choices(undirected(edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull())), "src", "dst", "weight", block)
    state = starts.select(F.col(id_col).alias("walk"), F.col(node_col).alias("start"), size.cast("int").alias("size")).withColumns({"at": F.col("start"), "seen": F.array("start")})
    steps = walk_length * (state.agg(F.max("size")).first()[0] or 0)
    for i in range(steps):
        busy = (F.size("seen") < F.col("size")) & (F.lit(i) < walk_length * F.col("size"))
        if i and i % 3 == 0:
            state = materialize(state)
            if state.filter(busy).isEmpty():
                break
        state = near.draw(state, "at", uniform(F.lit(seed), F.col("walk"), F.lit(i), F.lit("next")), "__next")
        back = (uniform(F.lit(seed), F.col("walk"), F.lit(i), F.lit("back")) < restart) | F.col("__next").isNull()
        to = F.when(~busy, F.col("at")).when(back, F.col("start")).otherwise(F.col("__next"))
        seen = F.when(busy & ~F.array_contains("seen", F.coalesce(to, "start")), F.concat("seen", F.array(to))).otherwise(F.col("seen"))
        state = state.select("walk", "start", "size", to.alias("at"), seen.alias("seen"))
    return state.select("walk", "start", "size", F.slice("seen", 2, F.greatest(F.size("seen") - 1, F.lit(0))).alias("nodes"))


def related_tools(walks: DataFrame, edges: DataFrame, most: int) -> DataFrame:
    """Walks (walk, start, size, nodes) topped up to ``size`` nodes with the start's heaviest neighbours (G2), and cut to that."""
    near = neighbors_topk(edges, most).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbor"))).alias("__near"))
    j = walks.join(near, F.col("start") == F.col("node"), "left").drop("node")
    short = F.greatest(F.col("size") - F.size("nodes"), F.lit(0))
    more = F.slice(F.transform(F.coalesce("__near", F.array().cast(near.schema["__near"].dataType)), lambda x: x["neighbor"]), F.lit(1), short)
    return j.withColumn("nodes", F.slice(F.array_union("nodes", more), F.lit(1), F.greatest("size", F.lit(0)))).drop("__near")


def scenario_combinations(
    tools: DataFrame, edges: DataFrame, target: int, least: int = 3, most: int = 6, seed: int = 7, restart: float = 0.15, walk_length: int = 6,
    id_col: str = "id", scenario_col: str = "scenario_id", block: int = BLOCK, quotas: DataFrame | None = None,
) -> DataFrame:
    """(scenario, number, start, tools): combinations of ``least`` to ``most`` distinct tools of a scenario.

    Each scenario with ``least`` tools or more has ``target`` // scenarios combinations, or as many as ``quotas`` (scenario, quota) gives it. One begins at a tool drawn
    evenly and wants a drawn number of tools: a walk over the scenario's edges brings them, its start's heaviest neighbours fill
    it up, and up to the least number further tools of the scenario are drawn evenly from those that are not in it. Tools without
    a scenario go, repeated tools of a scenario count once; edges have to stay within scenarios. All draws are hashes.
    """
    own = tools.filter(F.col(scenario_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(scenario_col).alias("scenario"), F.col(id_col).alias("tool")).distinct()
    sizes = own.groupBy("scenario").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    if quotas is None:
        one = sizes.agg(F.floor(F.lit(target) / F.count("*")).cast("int").alias("quota"))
        asked = sizes.join(F.broadcast(one))
    else:
        asked = sizes.join(quotas.select(F.col(quotas.columns[0]).alias("scenario"), F.col(quotas.columns[1]).cast("int").alias("quota")), "scenario")
    asked = asked.filter("quota > 0").select("scenario", F.explode(F.sequence(F.lit(0), F.col("quota") - 1)).alias("number"))
    members = Choices(own.withColumn("w", F.lit(1.0)), "scenario", "tool", "w", block)
    mark = lambda *what: uniform(F.lit(seed), F.col("scenario"), F.col("number"), *map(F.lit, what))
    begun = members.draw(asked, "scenario", mark("start"), "start").withColumn("wanted", (F.floor(mark("size") * (most - least + 1)) + least).cast("int"))
    begun = materialize(begun.withColumn("walk", F.concat_ws("/", F.col("scenario").cast("string"), F.col("number").cast("string"))))
    walked = related_tools(random_walks(begun, edges, F.col("wanted") - 1, walk_length, restart, seed, block=block), edges, most - 1)
    rows = begun.select("walk", "scenario", "number", "wanted").join(walked.select("walk", "start", "nodes"), "walk")
    rows = materialize(rows.select("scenario", "number", "start", F.slice(F.concat(F.array("start"), F.array_except("nodes", F.array("start"))), F.lit(1), F.col("wanted")).alias("tools")))
    done, rounds = [rows.filter(F.size("tools") >= least)], 0
    rows = rows.filter(F.size("tools") < least)
    while not rows.isEmpty():
        tries = rows.withColumn("__try", F.explode(F.sequence(F.lit(0), F.lit(7))))
        drawn = members.draw(tries, "scenario", uniform(F.lit(seed), F.col("scenario"), F.col("number"), F.lit(f"fill{rounds}"), F.col("__try")), "__tool")
        found = drawn.groupBy("scenario", "number").agg(F.transform(F.array_sort(F.collect_list(F.struct("__try", "__tool"))), lambda x: x["__tool"]).alias("__more"))
        rows = rows.join(found, ["scenario", "number"]).withColumn("tools", F.slice(F.array_union("tools", "__more"), 1, least)).drop("__more")
        rows, rounds = materialize(rows), rounds + 1
        done.append(rows.filter(F.size("tools") >= least))
        rows = rows.filter(F.size("tools") < least)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
