"""Queries that SQL can say give the same rows as their SQL."""

import duckdb
import pytest

from tallyweave.llm import queries
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.select(*columns).collect())
