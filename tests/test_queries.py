"""Every registered query against its DuckDB oracle on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as ep
from tidemark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "orders customer lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(str(canon(r[i])) for i in order) for r in data)


def test_entry(spark):
    df = ep.entry(spark)
    assert df.count() > 0 and "order_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ep.queries())
    assert set(QUERIES) <= set(ep.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = ep.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ep.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == rows(cols, res.fetchall())
