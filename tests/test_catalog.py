"""Every query with SQL gives the SQL's rows."""

import glob
import os

import duckdb
import pytest

from plateworks.plans import catalog

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(spark, tables, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    want = tables.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    text = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d[sorted(d.columns)].notna(), None).itertuples(index=False, name=None)))
    assert text(got) == text(want)


def test_entry_and_names():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
