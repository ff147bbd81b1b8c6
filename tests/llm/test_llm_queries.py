"""The queries that SQL can state give what DuckDB gives, and every query runs."""

import os

import duckdb
import pytest

from corpusmill.llm import queries as llm

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("corpus_doc", "chunk_doc"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = llm.queries()[name](spark, SF)
    done = con.execute(llm.oracle_sql()[name])
    assert [c[0] for c in done.description] == df.columns
    assert sorted(map(tuple, done.fetchall())) == sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("name", sorted(set(llm.queries()) - set(llm.oracle_sql())))
def test_query_runs(spark, name):
    assert llm.queries()[name](spark, SF).count() >= 0
