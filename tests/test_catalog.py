"""Every query with SQL equals DuckDB's answer on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from quire.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def plain(rows, columns):
    return sorted(tuple("~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in (r[columns.index(c)] for c in sorted(columns))) for r in rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    want = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert plain(got, df.columns) == plain(want.fetchall(), columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
