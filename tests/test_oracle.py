"""Every catalogue query equals its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(E.ORACLE_SQL)
    assert set(E.ORACLE_SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, SF, name, E.queries()[name], E.oracle_sql()[name])
    assert result["match"], result["detail"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sigla_uf", "count"]
    assert 0 < df.count() <= 10
