"""The queries that SQL can express, against DuckDB on whole tables."""

import duckdb
import pytest

from changefeed.llm import queries


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.sql(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    result = queries.queries()[name](spark, sf_dir)
    sql = duck.sql(queries.oracle_sql()[name])
    assert sorted(result.columns) == sorted(sql.columns)
    got = sorted((tuple(map(plain, r)) for r in result.select(*sql.columns).collect()), key=repr)
    want = sorted((tuple(map(plain, r)) for r in sql.fetchall()), key=repr)
    assert got == want and got
