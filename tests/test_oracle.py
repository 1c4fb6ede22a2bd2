"""Every registered query against its DuckDB oracle at sf0.01 (rows-only when no SQL)."""

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, duck
from tests.conftest import SF01

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    status, n, _, msg = compare(spark, con, name, QUERIES[name], SQL.get(name), SF01)
    assert status in ("OK", "ROWS"), msg
    assert n >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["sentiment", "n", "pct"]
    assert sum(r.n for r in rows) > 0
