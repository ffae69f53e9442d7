"""Every registered query with a SQL twin gives the twin's rows."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(frame):
    def one(v):
        if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return "null"
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str(list(v))
        try:
            return round(float(v), 6)
        except (TypeError, ValueError):
            return str(v)

    return sorted((tuple(map(one, row)) for row in frame[sorted(frame.columns)].itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_twin(spark, db, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), db.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
