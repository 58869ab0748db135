"""Every registered query against its SQL check."""

import duckdb
import pytest

import __spark_entry__ as entry
import compare

SF = "/root/testdata/sf0.001"
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in compare.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry._LLM_QUERIES])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in CHECKS:
        assert got
        return
    cur = con.execute(CHECKS[name])
    cols = [c[0] for c in cur.description]
    types = {c[0]: str(c[1]) for c in cur.description}
    assert sorted(cols) == sorted(df.columns)
    assert {c: compare.SAME_TYPE[t] for c, t in df.dtypes} == types
    assert compare.rows_of(df.columns, got) == compare.rows_of(cols, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["mes", "entradas", "saidas"]


def test_every_query_has_a_check():
    own = {n for n in entry.queries() if n not in entry._LLM_QUERIES}
    assert own <= set(CHECKS)
