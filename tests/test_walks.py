"""Walks, weighted choices and combinations."""

import pytest
from pyspark.sql import functions as F

from convoloom.functions.text import uniform
from convoloom.operators import graph, walks


def star(spark, n):
    """A hub 0 with n neighbours whose weights go 1, 2, 3, 0, 1, ..."""
    return spark.range(1, n + 1).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"), (F.col("id") % 4).cast("double").alias("weight"))


@pytest.mark.parametrize(("n", "block"), [(60_000, 300), (2000, 10)])
def test_draws_at_a_hub_follow_the_weights(spark, n, block):
    """Two or four levels of blocks of bounded size; a chi-square test of the weights' shares and of the neighbours' order."""
    near = walks.Choices(graph.undirected(star(spark, n)), "src", "dst", "weight", block)
    assert len(near.levels) == (2 if n == 60_000 else 4)
    assert max(level.agg(F.max(F.size("items"))).first()[0] for level in near.levels) <= 3 * block
    draws = 12_000
    got = near.draw(spark.range(draws).withColumn("at", F.lit(0).cast("long")), "at", uniform(F.lit(1), F.col("id")), "to")
    shares = {r["w"]: r["n"] for r in got.groupBy((F.col("to") % 4).alias("w")).agg(F.count("*").alias("n")).collect()}
    assert set(shares) == {1, 2, 3} and sum((shares[w] - draws * w / 6) ** 2 / (draws * w / 6) for w in (1, 2, 3)) < 14
    tenths = [r["n"] for r in got.groupBy(F.floor(F.col("to") * 10 / (n + 1))).agg(F.count("*").alias("n")).collect()]
    assert len(tenths) == 10 and sum((x - draws / 10) ** 2 / (draws / 10) for x in tenths) < 28


def test_choices_of_small_keys(spark):
    items = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 0.0), ("b", 3, 5.0), ("b", 4, None), ("b", 5, -1.0), (None, 6, 1.0)], "k string, i long, w double")
    near = walks.Choices(items, "k", "i", "w", 2)
    rows = spark.createDataFrame([(k, u) for k in ("a", "b", "c", None) for u in (0.0, 0.4, 0.6, 0.999999)], "k string, u double")
    got = {(r["k"], r["u"]): r["to"] for r in near.draw(rows, "k", F.col("u"), "to").collect()}
    assert {v for (k, _), v in got.items() if k == "a"} == {1, 2} and {v for (k, _), v in got.items() if k == "b"} == {3}
    assert {v for (k, _), v in got.items() if k in ("c", None)} == {None}


def test_walks_over_a_hub(spark):
    starts = spark.range(1, 400, 4).select(F.col("id").alias("walk"), F.col("id").alias("start"))
    got = walks.random_walks(starts, star(spark, 20_000), F.lit(4), restart=0.0, block=100).collect()
    assert len(got) == 100 and all(r["nodes"][0] == 0 and len(r["nodes"]) == 3 for r in got)
    again = walks.random_walks(starts.repartition(7), star(spark, 20_000), F.lit(4), restart=0.0, block=100).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_walks_are_topped_up_from_the_heaviest_neighbours(spark):
    edges = spark.createDataFrame([(0, i, i / 10) for i in range(1, 8)], "src long, dst long, weight double")
    made = spark.createDataFrame([("x", 0, 4, [3, 7]), ("y", 0, 2, [1, 2, 3]), ("z", 9, 3, [])], "walk string, start long, size int, nodes array<long>")
    got = {r["walk"]: r["nodes"] for r in walks.related_tools(made, edges, 5).collect()}
    assert got == {"x": [3, 7, 6], "y": [1, 2], "z": []}  # 7 is among the two heaviest already


def test_combinations(spark):
    """Quotas, sizes from three to six, distinct tools of one scenario, with edges and without any."""
    tools = spark.createDataFrame([(f"s{s}t{i}", f"s{s}") for s, n in enumerate([2, 3, 5, 40]) for i in range(n)] + [("lone", None), ("s1t0", "s1")], "id string, scenario_id string")
    edges = spark.createDataFrame([(f"s3t{i}", f"s3t{(i * 7 + 1) % 40}", 1.0) for i in range(40)], "src string, dst string, weight double")
    for e in (edges, edges.limit(0)):
        rows = walks.scenario_combinations(tools, e, 100).collect()
        count = {s: [r for r in rows if r["scenario"] == s] for s in ("s0", "s1", "s2", "s3")}
        assert [len(count[s]) for s in sorted(count)] == [0, 33, 33, 33]
        for r in rows:
            assert 3 <= len(r["tools"]) <= 6 and len(set(r["tools"])) == len(r["tools"]) and r["tools"][0] == r["start"]
            assert all(t.startswith(r["scenario"] + "t") for t in r["tools"])
        assert rows and sorted(map(str, rows)) == sorted(map(str, walks.scenario_combinations(tools.repartition(5), e, 100).collect()))
        if e is edges:
            assert {len(r["tools"]) for r in count["s3"]} >= {3, 4}
    assert walks.scenario_combinations(tools.limit(0), edges, 100).collect() == []
    own = spark.createDataFrame([("s1", 2), ("s3", 5), ("s9", 4)], "scenario string, quota int")
    assert len(walks.scenario_combinations(tools, edges, 0, quotas=own).collect()) == 7


def test_clusters_take_few_jobs(spark):
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(200)], "src long, dst long, weight double")
    spark.sparkContext.setJobGroup("clusters", "clusters")
    got = {r["start"]: r["cluster"] for r in graph.bfs_clusters(spark.range(200), edges, 6).collect()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("clusters")
    spark.sparkContext.setJobGroup("other", "other")
    assert got[100] == [100, 99, 101, 98, 102] or len(got[100]) == 6
    assert len(jobs) <= 24  # with AQE every shuffle of the one plan is a job of its own
