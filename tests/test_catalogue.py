"""Registered queries against their SQL on the smallest tables, and the driver's contract."""

import os

import pytest

import __spark_entry__ as entry
from gridloom.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    held = duck.sql(ORACLE[name])
    names = sorted(df.columns)
    assert names == sorted(held.columns)
    order = [held.columns.index(n) for n in names]
    assert plain(map(tuple, df.select(*[f"`{n}`" for n in names]).collect())) == plain(tuple(r[i] for i in order) for r in held.fetchall())


@needs_tables
def test_queries_without_sql_give_rows(spark):
    for name in set(QUERIES) - set(ORACLE):
        assert QUERIES[name](spark, SF).limit(1).count() == 1


@needs_tables
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["node", "source", "cost", "rank"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
