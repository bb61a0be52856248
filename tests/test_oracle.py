"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from changefeed.plans import oracle, queries as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, datetime):
        return value.isoformat()
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    result = contract.queries()[name](spark, sf_dir)
    got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    sql = duck.sql(contract.oracle_sql()[name])
    want = rows_of(sql.columns, sql.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "a query that returns nothing checks nothing"


def test_every_query_has_sql():
    assert registered.queries().keys() == oracle.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["shardId", "sequenceNumber", "id", "n", "value"]
    assert result.count() > 0
    assert result.filter("id IS NULL OR value IS NULL OR n IS NULL").isEmpty()
