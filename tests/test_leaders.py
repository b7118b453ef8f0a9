"""Greedy leaders of long chains and large components."""

import random

import pytest
from pyspark.sql import functions as F

from convoloom.operators import similarity


def brute(pairs):
    gone = set()
    for src, dst in sorted(pairs):
        if src not in gone:
            gone.add(dst)
    return gone


def pairs_of(spark, pairs, position=lambda c: c):
    df = spark.createDataFrame(sorted(pairs), "src long, dst long").repartition(4)
    return df.select("src", "dst", position(F.col("src")).alias("src_pos"), position(F.col("dst")).alias("dst_pos"))


def jobs_of(spark, work):
    """The result and how many jobs it took, with whole plans as jobs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setJobGroup("leaders", "leaders")
    try:
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("leaders"))
        got = work()
        return got, len(spark.sparkContext.statusTracker().getJobIdsForGroup("leaders")) - before
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setJobGroup("other", "other")


def test_a_chain_of_200_000(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PAIRS_A_SCAN", 1000)
    chain = spark.range(199_999).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.col("id").alias("src_pos"), (F.col("id") + 1).alias("dst_pos"))
    got, jobs = jobs_of(spark, lambda: similarity.settled(chain).agg(F.count("*").alias("n"), F.countDistinct("dst").alias("d"), F.min(F.col("dst") % 2).alias("odd")).first())
    assert (got["n"], got["d"], got["odd"]) == (100_000, 100_000, 1) and jobs < 100


@pytest.mark.parametrize(("seed", "scan"), [(0, 40), (1, 10_000)])
def test_graphs_of_many_kinds(spark, monkeypatch, seed, scan):
    """Chains, ladders, stars and random edges, with few pairs a task and looks from the first rounds on."""
    monkeypatch.setattr(similarity, "PAIRS_A_SCAN", scan)
    monkeypatch.setattr(similarity, "ROUNDS_A_LOOK", 2)
    r = random.Random(seed)
    pairs = {(i, i + 1) for i in range(80)} | {(i, i + k) for i in range(200, 230) for k in (1, 2)} | {(300, i) for i in range(301, 330)} | {(i, 330) for i in range(301, 330)}
    pairs |= {tuple(sorted(r.sample(range(400, 440), 2))) for _ in range(60)}
    got = [x["dst"] for x in similarity.settled(pairs_of(spark, pairs)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(pairs)


def test_pairs_at_equal_or_no_positions(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PAIRS_A_SCAN", 12)
    monkeypatch.setattr(similarity, "ROUNDS_A_LOOK", 1)
    pairs = {(i, i + k) for i in range(14) for k in (1, 2)}
    for position in (lambda c: F.lit(similarity.LAST), lambda c: F.floor(c / 7)):
        assert {x["dst"] for x in similarity.settled(pairs_of(spark, pairs, position)).collect()} == brute(pairs)
    assert similarity.settled(pairs_of(spark, pairs).limit(0)).collect() == []
