"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import glob
import os

import duckdb
import pytest

from siftline import catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or value != value:
        return "NULL"
    if isinstance(value, float) and value == int(value):
        return str(int(value))
    return str(value)


def rows(frame):
    frame = frame.astype(object).where(frame.notna(), None)
    return sorted(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in SQL:
        # no SQL to compare with: the result has rows and doesn't depend on how rows are dealt out
        assert len(got) > 0
        spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
        try:
            assert rows(QUERIES[name](spark, SF).toPandas()) == rows(got)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        return
    want = tables.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_sql_only_for_known_queries():
    assert not set(SQL) - set(QUERIES)
