"""Readers and writers: JSON documents and folders of them, text, listings, latest batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON array (or object) in one file, or files, as rows."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row a file with its whole text."""
    return spark.read.text(path, wholetext=True)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Path, name, size and modified of the files in a folder, or in all that a pattern names; a folder that is not there has none."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kind = "path string, name string, size long, modified timestamp"
    if not len(fs.globStatus(at) or ()):
        return spark.createDataFrame([], kind)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def latest_batch(spark: SparkSession, folder: str, glob: str) -> str | None:
    """The path of the file modified last (ties by path)."""
    row = list_files(spark, folder, glob).agg(F.max(F.struct("modified", "path")).alias("m")).first()
    return row["m"]["path"] if row["m"] else None


def latest_by_name(spark: SparkSession, folder: str, globs: list[str]) -> str | None:
    """The path with the greatest name under the first pattern that matches any."""
    for g in globs:
        row = list_files(spark, folder, g).agg(F.max("path").alias("p")).first()
        if row["p"]:
            return row["p"]
    return None


def read_folder(spark: SparkSession, folder: str, schema: T.StructType | str, glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """One object a file with its file name as ``_source_file``; and the files that hold no object, as rejects."""
    files = spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True).select(F.col("_metadata.file_name").alias("_source_file"), "value")
    kind = F.schema_of_variant(F.try_parse_json("value"))
    good = files.filter(kind.startswith("OBJECT")).select("_source_file", F.from_json("value", schema).alias("r")).select("r.*", "_source_file")
    return good, files.filter(~F.coalesce(kind.startswith("OBJECT"), F.lit(False))).select("_source_file", "value")


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "id", wrapper: str | None = None) -> DataFrame:
    """A list of records, an object of records by id, or either under ``wrapper``; the last record of an id wins."""
    v = F.try_parse_json("value")
    inner = F.coalesce(F.try_variant_get(v, f"$.{wrapper}", "variant"), v) if wrapper else v
    docs = spark.read.text(path, wholetext=True).select(inner.alias("v"))
    is_list = F.schema_of_variant("v").startswith("ARRAY")
    as_list = docs.filter(is_list).select(F.posexplode(F.expr("cast(v as array<variant>)")).alias("pos", "r"))
    as_map = docs.filter(~is_list).select(F.posexplode(F.map_values(F.expr("cast(v as map<string, variant>)"))).alias("pos", "r"))
    rows = as_list.union(as_map).select("pos", F.from_json(F.to_json("r"), schema).alias("r")).select("pos", "r.*")
    return last_wins(rows.filter(F.col(key).isNotNull()), key, "pos").drop("pos")


def last_wins(df: DataFrame, key: str, pos: str | None = None) -> DataFrame:
    """One row a key, null being one: the one furthest back by ``pos``, or the greatest by its columns in order (maps and variants
    aside). Rows are cut down to one a key before they are shuffled."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    simple = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return df.groupBy(key).agg(F.max_by(whole, F.struct(F.col(pos)) if pos else F.struct(*simple)).alias("__row")).select("__row.*")


def require_embeddings(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """The table, or an error if no row has an embedding."""
    if df.filter(F.size(vec_col) > 0).isEmpty():
        raise ValueError("no row has an embedding")
    return df


def require_list(spark: SparkSession, path: str) -> None:
    """An error unless the file holds a list."""
    kind = spark.read.text(path, wholetext=True).select(F.schema_of_variant(F.try_parse_json("value")).alias("k")).first()["k"]
    if not kind or not kind.startswith("ARRAY"):
        raise ValueError(f"{path} holds no list")


def write_batch(df: DataFrame, folder: str, kind: str, batch_id: str, fmt: str = "json") -> str:
    """K1, K4, K5, K9: append a batch as a partition of one dataset; returns its folder."""
    path = f"{folder}/{kind}"
    df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").partitionBy("batch_id").format(fmt).save(path)
    return f"{path}/batch_id={batch_id}"


def write_text(df: DataFrame, path: str, col: str = "value") -> None:
    """K2: one line a row."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_filtered(df: DataFrame, keep: Column, path: str) -> DataFrame:
    """K6: the rows that pass a condition, written as Parquet."""
    kept = df.filter(keep)
    kept.write.mode("overwrite").parquet(path)
    return kept


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """K7: a graph as two tables and a row of statistics: nodes, edges, and the mean and the extremes of the weights."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")
    weights = [f("weight").alias(f"{n}_weight") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))] if "weight" in edges.columns else []
    counted = nodes.agg(F.count("*").alias("nodes")).join(F.broadcast(edges.agg(F.count("*").alias("edges"), *weights)))
    counted.write.mode("overwrite").parquet(f"{path}/stats")


def load_graph(spark: SparkSession, path: str, attributes: DataFrame | None = None, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """K8: the tables of a graph; a missing weight is 0.5 and a missing type ``unknown``. Nodes that ``attributes`` knows get its
    other columns (of repeated ids the greatest row), which replace columns of theirs with those names; others have nulls."""
    edges = spark.read.parquet(f"{path}/edges")
    for name, kind in (("weight", "double"), ("edge_type", "string")):
        if name not in edges.columns:
            edges = edges.withColumn(name, F.lit(None).cast(kind))
    nodes = spark.read.parquet(f"{path}/nodes")
    if attributes is not None:
        nodes = nodes.select(*[c for c in nodes.columns if c == id_col or c not in attributes.columns]).join(last_wins(attributes, id_col), id_col, "left")
    return nodes, edges.withColumns({"weight": F.coalesce("weight", F.lit(0.5)), "edge_type": F.coalesce("edge_type", F.lit("unknown"))})


def ensure_directory(spark: SparkSession, path: str) -> str:
    """Makes a folder and its parents through Spark's file system; the folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)
    return path


def delete_path(spark: SparkSession, path: str) -> bool:
    """Removes a file or folder through Spark's file system; whether there was one."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def copy_path(spark: SparkSession, src: str, dst: str) -> None:
    """Copies a file or folder through Spark's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, conf)


def stream_parquet(spark: SparkSession, path: str, files_a_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files at ``path``, a folder or a single file, with the schema that they have now."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_a_batch:
        reader = reader.option("maxFilesPerTrigger", files_a_batch)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", at.getName()).parquet(str(at.getParent().toString()))
