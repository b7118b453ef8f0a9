import zlib
from collections import defaultdict

import pytest

from convoloom.llm.sharding import shard_by_bytes

from .helpers import EDGES, edge_docs, empty_docs


def brute(rows, k):
    """Shards by walking the rows in order."""
    data = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows))
    total = sum(d[3] for d in data)
    at, out = 0, []
    for has, i, crc, size in data:
        out.append((i if has else None, crc, size, min(k - 1, (2 * at + size) * k // (2 * total))))
        at += size
    return out


def check(df, rows, k):
    got = df.collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.text_crc32, r["size"], r.shard) for r in got), key=key) == sorted(brute(rows, k), key=key)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("k", [1, 3, 16])
def test_edges(spark, k):
    check(shard_by_bytes(edge_docs(spark), k), [(i, t) for i, t, _ in EDGES], k)


def test_empty(spark):
    assert shard_by_bytes(empty_docs(spark)).count() == 0


def test_hot_id_and_copies(spark):
    rows = [(5, f"text {i % 300}") for i in range(2000)] + [(9, "same")] * 9000 + [(None, f"t{i}") for i in range(500)] + [(i, "z" * (i % 50)) for i in range(1000)]
    check(shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 16, rows_a_bucket=50), rows, 16)


def test_balanced(spark):
    rows = [(i, "z" * (i * 37 % 100)) for i in range(3000)]
    got = shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string"), 16).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in got]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 2 * 101


def test_a_hot_id_has_as_many_parts_as_its_rows_need(spark):
    """Null and one hot id with many distinct texts, and few rows a bucket: shards, slots and order are those of a plain count."""
    texts = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"t{i}" * (1 + i % 5)) for i in range(3000)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    rows = shard_by_bytes(df, 4, rows_a_bucket=10).collect()
    order = sorted((r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size, r.shard, r.slot) for r in rows)
    total, before, slots = sum(r.size for r in rows), 0, {}
    for _, _, _, size, shard, slot in order:
        assert shard == min(3, (2 * before + size) * 4 // (2 * total)) and slot == slots.get(shard, 0)
        slots[shard] = slot + 1
        before += size
