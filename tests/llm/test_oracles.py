"""Queries of the operators that SQL can express, against DuckDB on the same tables."""

import duckdb
import pytest

from starloom.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    expected = sorted(map(tuple, result.fetchall()), key=repr)
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r) for r in df.select(columns).collect()), key=repr) == expected
    assert expected
