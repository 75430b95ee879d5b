"""Every registered query against DuckDB on the same tables."""

import datetime
import decimal
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from starloom.plans.oracles import ORACLES
from starloom.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = multiset(df.columns, df.collect()), multiset(columns, result.fetchall())
    assert sum(ours.values()) > 0
    assert ours == theirs


def test_entry(spark):
    assert driver.entry(spark).count() > 0
