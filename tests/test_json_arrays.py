"""JSON arrays read by splits and written in parts."""

import json
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from convoloom.sources import json_arrays as A
from convoloom.sources.files import read_keyed

NASTY = ['a,b', '"', "\\", '\\"', "}", "],[", "{", ",,", "\\\\", "\n", "é日本", "", ', "x": [', "\\,"]


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.sampled_from(NASTY), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.sampled_from(NASTY), x, max_size=3), max_leaves=12))
def test_structure(value):
    text = json.dumps(value, ensure_ascii=False).encode()
    steps, commas, quotes = A.structure(np.frombuffer(text, np.uint8), 0)
    assert steps.sum() == 0 and quotes % 2 == 0
    depth = np.cumsum(steps)
    if isinstance(value, list | dict) and value:
        assert (commas & (depth == 1)).sum() == len(value) - 1


def some(r):
    return {"id": r.randint(0, 50), "text": "".join(r.choice([*NASTY, "word "]) for _ in range(r.randint(0, 12))), "list": [[r.random()] * r.randint(0, 3)], "o": {"k,": r.choice(NASTY)}}


@pytest.mark.parametrize("bytes_", [64, 700, 1 << 20])
def test_items_over_splits(spark, tmp_path, bytes_):
    """Splits much smaller than an item, of about an item, and one for all."""
    r = random.Random(1)
    values = [some(r) for _ in range(150)] + [7, "x,y", None, [1, [2, 3]], {}, some(r)]
    (tmp_path / "a.json").write_text(json.dumps(values, ensure_ascii=False))
    (tmp_path / "b.json").write_text(" \n[\n" + ",\n".join(json.dumps(v, indent=1) for v in values[:40]) + "\n]\n")
    (tmp_path / "c.json").write_text("[]")
    (tmp_path / "d.json").write_text('{"a": 1, "b": [1, 2]}')
    (tmp_path / "e.json").write_text("")
    (tmp_path / "f.json").write_text("[5]")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = A.array_items(spark, f"{tmp_path}/*.json").collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    by = {}
    for x in sorted(got, key=lambda x: x["position"]):
        by.setdefault(x["file"][-6], []).append(json.loads(x["value"]))
    assert by == {"a": values, "b": values[:40], "f": [5]}
    assert len({(x["file"], x["position"]) for x in got}) == len(got)


def test_last_record_wins_as_in_the_whole_file(spark, tmp_path):
    r = random.Random(2)
    values = [{"id": str(r.randint(0, 20)), "v": i} for i in range(200)] + [{"v": 1}, 3]
    (tmp_path / "a.json").write_text(json.dumps(values))
    old = {(x["id"], x["v"]) for x in read_keyed(spark, f"{tmp_path}/a.json", "id string, v long").collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        assert {(x["id"], x["v"]) for x in A.read_keyed_array(spark, f"{tmp_path}/a.json", "id string, v long").collect()} == old
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_arrays_in_parts(spark, tmp_path):
    rows = spark.range(100).select("id", F.concat(F.lit('a,"}'), F.col("id").cast("string")).alias("s"), F.array("id").alias("l")).repartition(5)
    A.write_json_array(rows, f"{tmp_path}/out")
    files = [json.loads(f.read_text()) for f in (tmp_path / "out").glob("part-*")]
    assert sorted(x["id"] for f in files for x in f) == list(range(100)) and len(files) == 5
    back = A.read_json_array(spark, f"{tmp_path}/out", "id long, s string, l array<long>").drop("position")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    A.write_json_array(rows.limit(0), f"{tmp_path}/none")
    assert A.read_json_array(spark, f"{tmp_path}/none", "id long").collect() == []
