from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom.functions import date_key
from starloom.operators.dimensions import date_dim


def days(spark, *stamps):
    return spark.createDataFrame([(s,) for s in stamps], "ts timestamp")


@pytest.mark.parametrize("pattern", ["yyMMdd", "yyyyMMdd", "yyMM", "yyyyDDD"])
def test_date_key_equals_formatted_day(spark, pattern):
    df = spark.range(0, 60_000, 7).select(
        F.date_add(F.lit("1890-01-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    formatted = F.date_format("d", pattern).cast("int")
    assert df.where(date_key(F.col("d"), pattern) != formatted).count() == 0
    assert df.select(date_key(F.col("d"), pattern).alias("k")).schema["k"].dataType.typeName() == (
        "integer"
    )


def test_date_key_of_null_is_null(spark):
    assert days(spark, None).select(date_key(F.col("ts"))).first()[0] is None


def test_date_key_of_zoneless_timestamp(spark):
    df = days(spark, datetime(2005, 5, 24, 23, 59, 59)).select(F.col("ts").cast("timestamp_ntz"))
    assert df.select(date_key(F.col("ts"))).first()[0] == 50524


def test_date_dim_columns(spark, rows):
    assert rows(date_dim(days(spark, datetime(2005, 5, 24, 10)), "ts")) == [
        (50524, date(2005, 5, 24), 2005, 2, "2005Q2", 5, 24, 21, False)
    ]


def test_iso_week_keeps_calendar_year(spark, rows):
    assert rows(date_dim(days(spark, datetime(2005, 1, 1)), "ts")) == [
        (50101, date(2005, 1, 1), 2005, 1, "2005Q1", 1, 1, 53, True)
    ]


def test_weekend(spark):
    stamps = [datetime(2005, 5, d, 12) for d in range(23, 31)]
    found = {r["date"].day: r["is_weekend"] for r in date_dim(days(spark, *stamps), "ts").collect()}
    assert found == {23: False, 24: False, 25: False, 26: False, 27: False, 28: True, 29: True, 30: False}


def test_one_row_per_day_and_no_null(spark):
    df = days(spark, datetime(2005, 5, 24, 10), datetime(2005, 5, 24, 23, 59, 59), None)
    assert date_dim(df, "ts").count() == 1


def test_two_digit_years_clash_and_four_digit_do_not(spark):
    df = days(spark, datetime(1905, 5, 24), datetime(2005, 5, 24))
    assert [r["date_key"] for r in date_dim(df, "ts").collect()] == [50524, 50524]
    wide = date_dim(df, "ts", pattern="yyyyMMdd").collect()
    assert sorted(r["date_key"] for r in wide) == [19050524, 20050524]


def test_text_form(spark):
    row = date_dim(days(spark, datetime(2005, 5, 28)), "ts", as_text=True).first()
    assert (row["date_key"], row["is_weekend"]) == ("050528", "true")


def test_column_argument(spark):
    df = days(spark, datetime(2005, 5, 24))
    assert date_dim(df, F.col("ts") + F.expr("INTERVAL 1 DAY")).first()["date_key"] == 50525
