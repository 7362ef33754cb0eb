"""Every registered query against its SQL on DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from larderlake.workload.oracle import oracle
from larderlake.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def ordered(columns, data):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in places) for r in data)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(oracle())
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(oracle()) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "total_revenue" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    relation = duck.sql(entry_module.oracle_sql()[name])
    columns = list(relation.columns)
    assert sorted(df.columns) == sorted(columns)
    assert ordered(df.columns, df.collect()) == ordered(columns, relation.fetchall())
