"""The subpackage's queries with SQL give the SQL's rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

from convoloom.llm.queries import ORACLES, QUERIES
from convoloom.llm.quality_rules import apply_rules, document_counts, fit_forest

from .helpers import edge_docs, empty_docs

SF = "/root/testdata/sf0.001"


def plain(table, names):
    order = [names.index(c) for c in sorted(names)]
    return sorted((tuple(round(r[i], 4) if isinstance(r[i], float) else r[i] for i in order) for r in table), key=str)


@pytest.mark.parametrize("name", ["op13_centroid_clustering", "document_counts", "base_word_scores"])
def test_same_rows(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df, want = QUERIES[name](spark, SF), con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), want.columns)


def test_counts_alone_are_those_of_the_rules(spark):
    import numpy as np

    forest = fit_forest(np.zeros((0, 12)), np.zeros(0), [0] * 12)
    docs = edge_docs(spark)
    both = apply_rules(docs, forest).select(document_counts(docs).columns)
    assert sorted(map(str, document_counts(docs).collect())) == sorted(map(str, both.collect()))
    assert document_counts(empty_docs(spark)).count() == 0
