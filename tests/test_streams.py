"""Streams whose state expires, and tables that take up each batch once."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from convoloom.sources.files import stream_parquet
from convoloom.streaming import expiring, incremental

BEGAN = datetime(2024, 1, 1)
EVENT = "user_id long, event_id long, ts timestamp_ntz, kind string"


def sessions_of(spark, folder, late="10 minutes"):
    """One run over what there is now, from the checkpoint of the run before."""
    expiring.use_store(spark)
    closed = expiring.closed_sessions(stream_parquet(spark, f"{folder}/in"), F.col("kind") == "end", "30 minutes", 4, late)
    q = closed.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_sessions_close_and_state_goes(spark, tmp_path):
    """Late, early and repeated events, over three runs of one checkpoint; the same sessions as in one batch, and no state left
    but that of the last event."""
    r = random.Random(3)
    minutes = sorted(r.uniform(0, 900) for _ in range(220))
    events = [(r.choice([1, 2, 3, None]), i, BEGAN + timedelta(minutes=m), r.choice(["say"] * 6 + ["end", None])) for i, m in enumerate(minutes)]
    batches = [events[:80], events[80:150], events[150:]]
    moved = [e for e in batches[0] if e[2] > batches[0][-1][2] - timedelta(minutes=9)][::2]  # late, but not too late
    batches[0] = [e for e in batches[0] if e not in moved]
    batches[1] = batches[1] + moved + batches[1][-5:]
    batches[2] = batches[2] + batches[1][-3:-1] + [(9, 10_000, BEGAN + timedelta(days=3), "say")]
    for rows in batches:
        r.shuffle(rows)
        spark.createDataFrame(rows, EVENT).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        q = sessions_of(spark, str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/out")
    want = expiring.batch_sessions(spark.createDataFrame(events + batches[2][-1:], EVENT).union(spark.createDataFrame([(9, 10_000, BEGAN + timedelta(days=3), "say")], EVENT)), F.col("kind") == "end", "30 minutes", 4)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 50
    assert {r["reason"] for r in got.select("reason").distinct().collect()} == {"finish", "limit", "gap"}
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4


def test_state_is_kept_by_buckets_of_keys(spark, tmp_path, monkeypatch):
    """Many keys with open sessions hold state for each bucket, not for each key; names and null are keys."""
    monkeypatch.setattr(expiring, "BUCKETS", 8, raising=False)
    events = [(None if u == 0 else f"user {u} é", n, BEGAN + timedelta(minutes=20 * n + u % 7), "end" if (u + n) % 5 == 0 else "say") for u in range(300) for n in range(4)]
    named = EVENT.replace("user_id long", "user_id string")
    spark.createDataFrame(events, named).repartition(2).write.parquet(f"{tmp_path}/in")
    q = sessions_of(spark, str(tmp_path))
    got = spark.read.parquet(f"{tmp_path}/out")
    want = expiring.batch_sessions(spark.createDataFrame(events, named), F.col("kind") == "end", "30 minutes", 4)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 50
    assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 8 * 5


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    day = lambda m, i: (1, i, BEGAN + timedelta(minutes=m), "say")
    for rows in ([day(0, 1), day(100, 2)], [day(5, 3), day(95, 4)], [day(1000, 5)]):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        sessions_of(spark, str(tmp_path))
    got = sorted((r["turns"], r["reason"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(1, "gap"), (2, "gap")]  # minute 5 came too late, minute 95 did not


def test_batch_sessions_of_nothing(spark):
    assert expiring.batch_sessions(spark.createDataFrame([], EVENT), F.lit(True)).collect() == []


class Failing(incremental.KeyedTable):
    """Fails while its second batch is taken up: before or after the entry in the log."""

    when = "before"

    def _log(self, number, kind, part):
        if number == 1 and self.when == "before":
            raise RuntimeError("stopped")
        super()._log(number, kind, part)
        if number == 1 and self.when == "after":
            raise RuntimeError("stopped")


@pytest.mark.parametrize("when", ["before", "after"])
def test_batches_count_once(spark, tmp_path, when):
    rows = [[(1, 5, "a"), (2, 1, "b"), (None, 1, "n")], [(1, 6, "c"), (3, 1, "d"), (3, 2, "e")], [(1, 4, "f"), (4, 1, "g"), (None, 2, "m"), (2, 1, "later")]]
    schema = "k long, version long, v string"
    failing = Failing(spark, f"{tmp_path}/table", "k", ["version"])
    failing.when = when
    sound = incremental.KeyedTable(spark, f"{tmp_path}/table", "k", ["version"])
    for n, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(f"{tmp_path}/in")
        if n == 1:
            with pytest.raises(Exception, match="stopped"):
                incremental.feed(stream_parquet(spark, f"{tmp_path}/in"), failing, f"{tmp_path}/offsets")
        incremental.feed(stream_parquet(spark, f"{tmp_path}/in"), sound, f"{tmp_path}/offsets")
    want = {(1, 6, "c"), (2, 1, "later"), (3, 2, "e"), (4, 1, "g"), (None, 2, "m")}
    assert {tuple(r) for r in sound.rows().select("k", "version", "v").collect()} == want and [n for n, _, _ in sound.entries()] == [0, 1, 2]
    once = incremental.KeyedTable(spark, f"{tmp_path}/once", "k", ["version"])
    incremental.feed(stream_parquet(spark, f"{tmp_path}/in"), once, f"{tmp_path}/offsets2")
    assert {tuple(r)[:2] for r in once.rows().select("k", "version").collect()} == {r[:2] for r in want}
    sound.compact()
    assert [(n, kind) for n, kind, _ in sound.entries()] == [(2, "all")] and sound.taken(1) and not sound.taken(3)
    assert {tuple(r) for r in sound.rows().select("k", "version", "v").collect()} == want
    sound.take(spark.createDataFrame([(1, 9, "old batch")], schema), 1)
    sound.take(spark.createDataFrame([(5, 1, "h")], schema), 3)
    assert {tuple(r) for r in sound.rows().select("k", "version", "v").collect()} == want | {(5, 1, "h")}
    tasks = spark.createDataFrame([(1,), (7,), (None,)], "t long")
    assert sorted(map(str, (r["t"] for r in sound.pending(tasks, "t").collect()))) == ["7", "None"]


def test_nothing_taken_up_yet(spark, tmp_path):
    t = incremental.KeyedTable(spark, f"{tmp_path}/table", "k", ["v"])
    t.compact()
    assert t.rows() is None and t.entries() == [] and t.pending(spark.range(2), "id").count() == 2
