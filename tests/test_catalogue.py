"""Every catalogue query gives rows, and the same ones as its SQL where it has one."""

import decimal
import math

import duckdb
import pytest

from tallyweave.plans import catalogue
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.9g}"
    return str(value)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, oracle, name):
    df = catalogue.queries()[name](spark, DATA)
    found = df.collect()
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    want = oracle.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, found) == rows(want.columns, want.fetchall())


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
