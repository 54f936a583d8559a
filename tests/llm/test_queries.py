"""Every registered query runs over its whole tables, and gives its SQL's rows where there is SQL."""

import glob
import os

import duckdb
import pytest

from plateworks.llm import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
#: Queries with one row for every document.
WHOLE = {"op2_pii_surrogates", "op4_mixing", "op5_language_id", "op7_token_files", "op8_host_rules", "op9_near_dup", "op10_secret_scan", "op11_importance_resampling", "op12_license_scan", "op13_token_alignment"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, name):
    got = queries.QUERIES[name](spark, DATA).toArrow()
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    if name in WHOLE:
        assert sorted(got["doc_id"].to_pylist()) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    if name in queries.ORACLE_SQL:
        con = duckdb.connect()
        for path in glob.glob(f"{DATA}/*.parquet"):
            con.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
        want = con.sql(queries.ORACLE_SQL[name]).to_arrow_table()
        assert sorted(got.column_names) == sorted(want.column_names)
        rows = lambda d: sorted(str(sorted(r.items())) for r in d.to_pylist())
        assert rows(got) == rows(want)


def test_one_query_for_each_operator():
    assert [sum(n.startswith(f"op{k}_") for n in queries.QUERIES) for k in range(1, 14)] == [1] * 13
