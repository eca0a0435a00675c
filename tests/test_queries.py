"""Every query of the library against its SQL, and its shape where SQL has none."""

import duckdb
import pytest

import quillon.queries_files
import quillon.queries_more  # noqa: F401
from quillon.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents labels benchmark conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = sorted(repr(tuple(r)) for r in df.collect())
    if name not in SQL:
        assert got
        return
    out = duck.execute(SQL[name])
    columns = [d[0] for d in out.description]
    assert sorted(columns) == sorted(df.columns)
    place = [columns.index(c) for c in df.columns]
    assert got == sorted(repr(tuple(r[i] for i in place)) for r in out.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
