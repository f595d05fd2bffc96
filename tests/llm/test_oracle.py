"""Operators that SQL can express, against DuckDB."""

import duckdb
import pytest

from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    got = QUERIES[name](spark, SF_SMALL)
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
