"""Every registered query against its DuckDB oracle (small scale)."""

import pytest

import __spark_entry__ as E
from compare import compare, duckdb_connection

from conftest import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    if name not in ORACLE:
        assert df.count() >= 0
        return
    r = compare(df, con, ORACLE[name])
    assert r["columns_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["match"], r["rows"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 94          # FIXTURES.md: mart rows, all days, sf0.001
