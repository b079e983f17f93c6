"""Every query with SQL against DuckDB, on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import pytest

from tickloom.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    frame = registry.queries()[name](spark, DATA)
    columns = sorted(frame.columns)
    got = sorted(tuple(map(plain, r)) for r in frame.select(*columns).collect())
    if name not in registry.oracle_sql():
        assert got
        return
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    at = [list(want.columns).index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
