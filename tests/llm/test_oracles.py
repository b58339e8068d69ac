"""The operators that SQL can express equal their DuckDB oracle on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

from oracle_check import TABLES, compare  # noqa: E402
from terrapipe.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = compare(spark, con, SF, name, QUERIES[name], ORACLE_SQL[name])
    assert result["match"], result["detail"]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
