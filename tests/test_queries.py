"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from convoloom.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    return round(v, 6) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list) else v


def rows(table, names):
    order = [names.index(c) for c in sorted(names)]
    return sorted((tuple(plain(r[i]) for i in order) for r in table), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, SF)
    want = db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
