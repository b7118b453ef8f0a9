"""Queries that write to the shared folder and read back what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVALUATION
from ..session import ensure_checkpoint_dir
from ..sources import files, json_arrays
from .conversation_queries import training_table
from .registry import ORACLES, query, table


def io_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application beside its checkpoints, empty."""
    path = f"{ensure_checkpoint_dir(spark)}/convoloom_io_{spark.sparkContext.applicationId}/{name}"
    files.delete_path(spark, path)
    return files.ensure_directory(spark, path)


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def batch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two JSON batches of one dataset, read as one."""
    path = io_folder(spark, "batches")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    files.write_batch(rows.filter("id % 2 = 0"), path, "agents", "1")
    files.write_batch(rows.filter("id % 2 = 1"), path, "agents", "2")
    return spark.read.schema(rows.schema).json(f"{path}/agents").select("id", "name", "balance")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 2 = 0")
def latest_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the batch with the greatest name."""
    path = io_folder(spark, "latest")
    rows = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    for n in (1, 0):
        rows.filter(F.col("id") % 2 == 1 - n).coalesce(1).write.mode("overwrite").json(f"{path}/run_{n}")
    newest = files.latest_by_name(spark, f"{path}/run_*", ["*none*", "*.json"])
    return spark.read.schema(rows.schema).json(newest)


@query("SELECT string_agg(r_name, '|' ORDER BY r_name) AS names FROM region")
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as text, and whole files read."""
    path = io_folder(spark, "text")
    files.write_text(table(spark, sf_dir, "region").coalesce(1), f"{path}/names", "r_name")
    lines = files.read_text(spark, f"{path}/names").select(F.explode(F.split("value", "\n")).alias("n")).filter("n <> ''")
    return lines.agg(F.array_join(F.array_sort(F.collect_list("n")), "|").alias("names"))


@query("SELECT p_partkey AS id, p_size AS size FROM part WHERE p_size > 25")
def filtered_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: rows that pass, written and read."""
    path = io_folder(spark, "filtered")
    files.write_filtered(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size")), F.col("size") > 25, f"{path}/rows")
    return spark.read.parquet(f"{path}/rows")


@query(
    """WITH e AS (SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst FROM customer JOIN supplier ON c_custkey = s_suppkey),
  s AS (SELECT (SELECT count(*) FROM nation) AS nodes, (SELECT count(*) FROM e) AS edges)
  SELECT src, dst, n_name AS name, CASE WHEN src % 2 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS weight, 'unknown' AS edge_type, nodes, edges FROM e LEFT JOIN nation ON src = n_nationkey, s"""
)
def graph_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, K8: a graph written with its statistics, read with defaults and the attributes of its nodes."""
    path = io_folder(spark, "graph")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    pairs = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "supplier"), F.col("c_custkey") == F.col("s_suppkey"))
    edges = pairs.select(F.col("c_nationkey").alias("src"), F.col("s_nationkey").alias("dst")).distinct()
    files.save_graph(nations.select("id"), edges.withColumn("weight", F.when(F.col("src") % 2 == 0, 1.0)), path)
    nodes, edges = files.load_graph(spark, path, nations)
    stats = spark.read.parquet(f"{path}/stats").select("nodes", "edges")
    return edges.join(nodes.withColumnRenamed("id", "src"), "src", "left").join(F.broadcast(stats))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(n_regionkey AS DOUBLE) AS overall_score FROM nation")
def keyed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON list under a wrapper; a first record of every id is overruled by the last."""
    path = io_folder(spark, "keyed")
    one = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("double").alias("overall_score"))
    nations = table(spark, sf_dir, "nation").select(one.alias("r"))
    older = nations.select(F.col("r").withField("overall_score", F.lit(-1.0)).alias("r"))
    lists = [df.agg(F.collect_list("r").alias("l")) for df in (older, nations)]
    both = lists[0].withColumnRenamed("l", "a").join(lists[1]).select(F.to_json(F.struct(F.concat("a", "l").alias("evaluations"))).alias("value"))
    files.write_text(both.coalesce(1), f"{path}/evaluations")
    return files.read_keyed(spark, f"{path}/evaluations/*.txt", EVALUATION, wrapper="evaluations").select("id", "name", "overall_score")


@query("SELECT n_nationkey % 5 AS kind, count(*) AS files, count(*) FILTER (n_nationkey % 5 <> 4) AS objects FROM nation GROUP BY 1")
def folder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for every nation, some of which hold no object."""
    path = io_folder(spark, "folder")
    kind = F.col("n_nationkey") % 5
    body = F.when(kind == 4, "[1]").otherwise(F.to_json(F.struct(kind.alias("kind"), F.col("n_name").alias("name"))))
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("n"), body.alias("value")).coalesce(1).write.mode("overwrite").partitionBy("n").text(f"{path}/all")
    good, bad = files.read_folder(spark, f"{path}/all/*", "kind long, name string", "*.txt")
    listed = files.list_files(spark, f"{path}/all/n=0", "*.txt").filter("size > 0").agg(F.count("*").alias("listed"))
    both = good.select("kind", F.lit(1).alias("object")).unionByName(bad.select(F.lit(4).cast("long").alias("kind"), F.lit(0).alias("object")))
    return both.join(F.broadcast(listed)).filter("listed = 1").groupBy("kind").agg(F.count("*").alias("files"), F.sum("object").alias("objects"))


@query("SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_regionkey = 1")
def latest_time_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the file that was written last, whose name is not the greatest."""
    path = io_folder(spark, "latest_time")
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), "n_regionkey")
    for name, region in (("run_b", 0), ("run_c", 2), ("run_a", 1)):
        rows.filter(F.col("n_regionkey") == region).select("id", "name").repartition(1).write.mode("overwrite").json(f"{path}/{name}")
    return spark.read.schema("id int, name string").json(files.latest_batch(spark, f"{path}/run_*", "*.json"))


@query(ORACLES["training_table"])
def training_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table written as JSON arrays in parts, and read from these."""
    path = io_folder(spark, "training")
    rows = training_table(spark, sf_dir)
    json_arrays.write_json_array(rows, f"{path}/rows")
    return json_arrays.read_json_array(spark, f"{path}/rows", rows.schema).drop("position")


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_size AS size FROM part")
def keyed_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays in which a later item overrules an earlier one of the same id, read by splits."""
    path = io_folder(spark, "keyed_array")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    both = parts.withColumn("twice", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("size", F.when(F.col("twice") == 1, F.col("size")).otherwise(-1))
    by_id = both.repartition("id").sortWithinPartitions("id", "twice").drop("twice")
    json_arrays.write_json_array(by_id, f"{path}/parts")
    return json_arrays.read_keyed_array(spark, f"{path}/parts", "id string, name string, size int")
