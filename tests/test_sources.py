import json
import os

import pytest
from pyspark.sql import functions as F

from convoloom import schemas
from convoloom.sources import files as S
from convoloom.streaming import sessions


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "name": "x"}, {"id": "2", "name": "é"}]))
    assert sorted(r.name for r in S.read_json(spark, str(tmp_path / "a.json"), schemas.EVALUATION).collect()) == ["x", "é"]
    assert S.read_text(spark, str(tmp_path / "a.json")).count() == 1
    S.require_list(spark, str(tmp_path / "a.json"))
    (tmp_path / "b.json").write_text("{}")
    with pytest.raises(ValueError):
        S.require_list(spark, str(tmp_path / "b.json"))
    with pytest.raises(ValueError):
        S.require_embeddings(spark.createDataFrame([([],)], "embedding array<double>"))


def test_latest(spark, tmp_path):
    for i, n in enumerate(("tools_batch_2.json", "tools_batch_1.json", "tools_refined_0.json")):
        (tmp_path / n).write_text("[]")
        os.utime(tmp_path / n, (1000 + i, 1000 + i))
    assert S.latest_batch(spark, str(tmp_path), "tools_batch*").endswith("tools_batch_1.json")
    assert S.latest_by_name(spark, str(tmp_path), ["*tools_refined*", "*tools_batch*"]).endswith("refined_0.json")
    assert S.latest_by_name(spark, str(tmp_path), ["*none*", "*tools_batch*"]).endswith("batch_2.json")
    assert S.latest_batch(spark, str(tmp_path / "missing"), "*") is None
    assert {r.name for r in S.list_files(spark, str(tmp_path), "*.json").collect()} == set(os.listdir(tmp_path))


def test_folder_and_rejects(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"trajectory_id":"t1","score":4.5}')
    (tmp_path / "list.json").write_text("[1]")
    (tmp_path / "bad.json").write_text("{oops")
    good, bad = S.read_folder(spark, str(tmp_path), schemas.TRAJECTORY)
    assert [(r.trajectory_id, r._source_file) for r in good.collect()] == [("t1", "good.json")]
    assert {r._source_file for r in bad.collect()} == {"list.json", "bad.json"}


def test_keyed(spark, tmp_path):
    forms = {
        "list": [{"id": "a", "overall_score": 1.0}, {"id": "b", "overall_score": 2.0}, {"id": "a", "overall_score": 3.0}],
        "map": {"x": {"id": "a", "overall_score": 3.0}, "y": {"id": "b", "overall_score": 2.0}},
    }
    forms["wrapped"] = {"agents": forms["list"]}
    for name, data in forms.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(data))
        got = S.read_keyed(spark, str(tmp_path / f"{name}.json"), schemas.EVALUATION, wrapper="agents")
        assert {r.id: r.overall_score for r in got.collect()} == {"a": 3.0, "b": 2.0}, name


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n long")
    at = S.write_batch(df, str(tmp_path), "tools", "20240101_000000")
    assert spark.read.json(at).count() == 2
    S.write_text(df, str(tmp_path / "text"), "id")
    assert spark.read.text(str(tmp_path / "text")).count() == 2
    assert S.write_filtered(df, F.col("n") > 1, str(tmp_path / "kept")).count() == 1
    S.copy_path(spark, str(tmp_path / "kept"), str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy")).count() == 1
    assert S.delete_path(spark, str(tmp_path / "copy")) and not S.delete_path(spark, str(tmp_path / "copy"))
    S.save_graph(df, spark.createDataFrame([("a", "b")], "src string, dst string"), str(tmp_path / "g"))
    e = S.load_graph(spark, str(tmp_path / "g"))[1].first()
    assert (e.weight, e.edge_type) == (0.5, "unknown")


def run(df, mode):
    q = df.writeStream.outputMode(mode).format("memory").queryName("out").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return df.sparkSession.sql("SELECT * FROM out")


def test_streams(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src)
    (tmp_path / "events").mkdir()
    os.symlink(src, tmp_path / "events/part.parquet")
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "events"))
    got = {(r.start, r.event_type): r.n for r in run(sessions.windowed_usage(stream), "complete").collect()}
    want = {(r.start, r.event_type): r.n for r in sessions.windowed_usage(batch).collect()}
    assert got == want
    assert run(sessions.distinct_events(stream.union(stream)), "append").count() == batch.select("event_id").distinct().count()
    turns = {r.user_id: r.turns for r in run(sessions.turn_counts(stream), "update").collect()}
    assert turns == {r.user_id: r["count"] for r in batch.groupBy("user_id").count().collect()}
    assert run(sessions.session_windows(stream), "complete").count() == sessions.session_windows(batch).count()
