"""What keeps time and memory in proportion to the input: each answer parsed once, calls dealt evenly, bounded blocks."""

import numpy as np
from pyspark.sql import functions as F

from convoloom.llm import lm_score
from convoloom.operators import components, generation, provider, records, similarity
from convoloom.operators.components import connected_components


def test_answers_are_parsed_once(spark):
    """The plan holds one reading of the answer, however many fields and rules use it."""
    asked = spark.range(20).select(F.col("id").cast("string").alias("key"), F.lit("simple").alias("difficulty"), F.array(F.lit("search")).alias("tools"))
    made = generation.generate_tasks(asked)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json(") == 1
    keys = {r.key for r in made.collect()}
    assert keys == {str(i) for i in range(20) if "search(" in generation.stub_json_provider(f"KIND: task\nKEY: {i}\nCOUNT: 1")}


def test_calls_of_one_small_file_are_dealt(spark):
    """Rows that come in one partition are asked in several, each once, errors kept."""
    rows = spark.range(0, 400, 1, 1).select("id", F.when(F.col("id") % 50 == 0, "FAIL").otherwise(F.col("id").cast("string")).alias("prompt"))
    for made in (provider.complete(rows, "id", "prompt"), provider.embed(rows, "id", "prompt", 4)):
        assert made.select(F.spark_partition_id().alias("p")).distinct().count() > 1
        assert sorted(r.id for r in made.collect()) == list(range(400))
    assert {r.id for r in provider.complete(rows, "id", "prompt").collect() if r.error} == {i for i in range(400) if i % 50 == 0}


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    out = run()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("tests", "tests")
    return out, n


def test_components_of_one_partition_take_few_jobs(spark):
    """A chain takes no rounds of its own, whatever its length; ids are compared as Spark compares them."""
    for n in (50, 3000):
        edges = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
        got, jobs = _jobs(spark, f"chain{n}", lambda: connected_components(edges).collect())  # noqa: B023
        assert {(r.id, r.component) for r in got} == {(i, 0) for i in range(n + 1)} and jobs < 16
    words = spark.createDataFrame([("z", "é"), ("é", "Z"), ("a", "a"), (None, "b"), ("b", "😀")], "src string, dst string")
    assert {(r.id, r.component) for r in connected_components(words).collect()} == {("z", "Z"), ("é", "Z"), ("Z", "Z"), ("a", "a"), ("b", "b"), ("😀", "b")}


def test_components_over_partitions(spark, monkeypatch):
    """Stars of several partitions are joined by the rounds."""
    monkeypatch.setattr(components, "EDGES_A_PARTITION", 40)
    edges = spark.range(0, 600, 1, 8).filter("id % 100 <> 99").select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    assert {(r.id, r.component) for r in connected_components(edges).collect()} == {(i, i // 100 * 100) for i in range(600)}


def test_base_scores_train_nothing(spark, monkeypatch):
    """Without the model the other columns are the same, and no model is trained for them."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).localCheckpoint()
    whole = lm_score.score_documents(docs).drop("score").collect()
    monkeypatch.setattr(lm_score, "train", None)
    assert sorted(map(str, lm_score.score_documents(docs, model=False).collect())) == sorted(map(str, whole))


def test_slices_keep_what_their_rows_need():
    """Of 6 pairs of two rows the two most similar of each, ties by position."""
    x, y, s = np.array([0, 1, 0, 0, 1, 0]), np.array([5, 4, 3, 2, 3, 4]), np.array([0.5, 0.1, 0.9, 0.5, 0.3, 0.5])
    got = similarity._most_similar(x, y, s, np.array([0, 1, 9, 3, 4, 5]), 2)
    assert [c.tolist() for c in got] == [[0, 0, 1, 1], [3, 4, 3, 4], [0.9, 0.5, 0.3, 0.1]]


def test_sessions_are_dealt(spark):
    """Tasks of one partition are run in several; a null list of tools is an empty one."""
    rows = spark.range(0, 60, 1, 1).select(F.col("id").alias("task_id"), F.lit(1).alias("agent_id"), F.when(F.col("id") > 9, F.array(F.lit("search"))).alias("tools"))
    made = provider.run_sessions(rows).withColumn("p", F.spark_partition_id()).collect()
    assert len({r.p for r in made}) > 1 and {r.task_id for r in made} == {str(i) for i in range(60)}
    assert not any(r.recipient == "execution" for r in made if int(r.task_id) < 10)
    assert provider.run_sessions(rows.limit(0)).count() == 0


def test_agent_records_deal_schemas_evenly(spark, monkeypatch):
    """Partitions follow from the number of schemas, not from their compressed bytes, and the records stay the same."""
    none = F.array().cast("array<struct<name:string,type:string,description:string,required:boolean,enum:array<string>>>")
    tools = spark.range(20).select("id", F.concat(F.lit("tool "), "id").alias("name"), F.lit("same text").alias("description"), none.alias("parameters"))
    combos = spark.createDataFrame([(c, [c % 20, (c + 7) % 20, 99]) for c in range(100)] + [(100, []), (101, None), (102, [99])], "id long, tool_ids array<long>")
    plain = records.agent_records(combos, tools, "T: {tools_list}")
    want = sorted(map(str, plain.collect()))
    monkeypatch.setattr(records, "SCHEMAS_A_PARTITION", 30, raising=False)
    dealt = records.agent_records(combos, tools, "T: {tools_list}")
    assert dealt.rdd.getNumPartitions() == 11  # 301 tools in lists of three and one
    assert sorted(map(str, dealt.collect())) == want and len(want) == 101
    assert sum(r["system_prompt"] == "T: " for r in dealt.collect()) == 1
