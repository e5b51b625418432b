"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare, connect

BASE = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(BASE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, BASE)
    rows = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name not in SQL:
        assert rows, "a query without SQL must return something"
        return
    cur = db.execute(SQL[name])
    assert compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["l_partkey", "p_name", "avg_value", "cnt"]
