"""Samples by hash and quotas."""

import random
from math import floor

import pytest
from pyspark.sql import functions as F

from convoloom.operators import sampling


@pytest.mark.parametrize("n", [1, 49, 50, 51, 150, 999, 1000, 5000])
def test_samples_without_a_sort(spark, monkeypatch, n):
    """Histograms give the rows that a sort of all gives, also with repeated keys and rows."""
    rows = spark.range(900).select((F.col("id") % 700).alias("k"), (F.col("id") % 3).alias("v")).union(spark.range(100).select(F.lit(5).cast("long"), F.lit(None).cast("long")))
    ordered = sampling.hash_sample(rows, n, F.col("k")).collect()
    monkeypatch.setattr(sampling, "MOST_RANKED", 10)
    monkeypatch.setattr(sampling, "DIGITS", 1)
    got = sampling.hash_sample(rows.repartition(6), n, F.col("k")).collect()
    assert sorted(map(str, got)) == sorted(map(str, ordered)) and len(got) == min(n, 1000)


def test_samples_of_nothing_and_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "MOST_RANKED", 10)
    monkeypatch.setattr(sampling, "DIGITS", 8)
    same = spark.range(300).select(F.lit("x").alias("k"))
    assert sampling.hash_sample(same, 100, F.col("k")).count() == 100 and sampling.hash_sample(same.limit(0), 100, F.col("k")).count() == 0
    assert sampling.hash_sample(same, 0, F.col("k")).count() == 0


def brute(weights, caps, target):
    quota = dict.fromkeys(weights, 0)
    while True:
        free, rest = sorted(g for g in weights if quota[g] < caps[g]), target - sum(quota.values())
        if rest <= 0 or not free:
            return quota
        total = sum(weights[g] for g in free)
        share = {g: weights[g] * (rest / total) if total else rest / len(free) for g in free}
        missing = rest - sum(floor(x) for x in share.values())
        extra = sorted(free, key=lambda g: (-(share[g] - floor(share[g])), g))[:missing]
        for g in free:
            quota[g] = min(caps[g], quota[g] + floor(share[g]) + (g in extra))


@pytest.mark.parametrize("seed", range(4))
def test_quotas_add_up(spark, seed):
    r = random.Random(seed)
    weights = {f"g{i:02}": float(r.choice([0, 1, 2, 5, 50])) for i in range(20)}
    caps = {g: r.choice([0, 3, 20, 400]) for g in weights}
    target = r.choice([7, 100, 900])
    df = spark.createDataFrame([(g, weights[g], caps[g]) for g in weights], "g string, w double, c int")
    got = {x["group"]: x["quota"] for x in sampling.apportion(df, target, "g", F.col("w"), F.col("c")).collect()}
    assert got == brute(weights, caps, target) and sum(got.values()) == min(target, sum(caps.values()))
    free = {x["group"]: x["quota"] for x in sampling.apportion(df, target, "g", F.col("w")).collect()}
    assert sum(free.values()) == target


def test_quotas_of_equal_or_no_groups(spark):
    df = spark.createDataFrame([("a", None), ("b", -1.0), ("b", 0.0), (None, 0.0)], "g string, w double")
    got = {x["group"]: x["quota"] for x in sampling.apportion(df, 10, "g", F.col("w")).collect()}
    assert got == {None: 4, "a": 3, "b": 3} and sampling.apportion(df.limit(0), 10, "g", F.col("w")).collect() == []
