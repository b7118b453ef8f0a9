"""A corpus pipeline over ``documents``: judge, deduplicate, decontaminate, redact, encode.

Every stage takes (spark, docs, sf_dir) and works on all rows it is given; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoloom.llm import decontamination, jaccard_join, quality_perplexity, secret_scan, sentencepieces
from convoloom.llm.queries import tokenizer_file
from convoloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents above their language's perplexity limit go."""
    return quality_perplexity.keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays: the one with the least id."""
    return jaccard_join.keep_representatives(docs.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text and n_chars follows; all documents stay."""
    return secret_scan.redact_secrets(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document that is left."""
    return sentencepieces.encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("sentencepiece_encoding", sentencepiece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage keeps is written to the checkpoint folder before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can express neither the quality model nor the piece ids.
ORACLE_SQL = None
