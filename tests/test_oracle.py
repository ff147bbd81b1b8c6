"""Every core query that SQL can state gives what DuckDB gives."""

import glob
import os

import duckdb
import pytest

from corpusmill import queries as core

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = core.queries()[name](spark, SF)
    done = db.execute(core.oracle_sql()[name])
    columns = [c[0] for c in done.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(repr(plain([r[columns.index(c)] for c in sorted(columns)])) for r in done.fetchall())
    assert sorted(repr(plain([r[c] for c in sorted(columns)])) for r in df.collect()) == expected


def test_contained_in_volumes_equals_sql(spark, db):
    rows = db.execute(core.CONTAINED_SQL).fetchall()
    assert rows and sorted(map(tuple, core.queries()["contained_in_volumes"](spark, SF).collect())) == sorted(rows)


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_query_runs(spark, name):
    assert core.queries()[name](spark, SF).count() >= 0
