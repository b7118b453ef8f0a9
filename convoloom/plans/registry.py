"""Where queries register themselves with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; without SQL only tests hold it to a result."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    """``text`` over some of the tables, whose names stand in ``<>``."""
    for t in tables:
        table(spark, sf_dir, t).createOrReplaceTempView(f"convoloom_{t}")
        text = text.replace(f"<{t}>", f"convoloom_{t}")
    return spark.sql(text)
