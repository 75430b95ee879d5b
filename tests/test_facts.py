from decimal import Decimal as D

from pyspark.sql import functions as F

from starloom.operators.dimensions import date_dim
from starloom.operators.facts import fact_sales


def build(s, **kw):
    return fact_sales(s["payment"], s["rental"], s["inventory"], **kw)


def test_open_rentals_only(sources, rows):
    df = build(sources)
    assert df.columns == (
        "sales_key payment_date_key rental_date_key return_date_key customer_key staff_key "
        "store_key movie_key sales_amount"
    ).split()
    assert rows(df) == [
        (1, 50524, 50524, None, 1, 1, 1, 1, D("2.99")),
        (3, 50601, 50524, None, 1, 2, 1, 1, D("1.00")),
        (4, None, 50529, None, 3, 2, 1, 2, D("4.99")),
    ]


def test_all_rentals(sources, rows):
    df = build(sources, open_only=False)
    assert df.schema == build(sources).schema
    assert (2, 50528, 50524, 50528, 2, 1, 2, 2, D("0.99")) in rows(df)
    assert df.count() == 4


def test_four_digit_keys(sources):
    keys = {r["rental_date_key"] for r in build(sources, pattern="yyyyMMdd").collect()}
    assert keys == {20050524, 20050529}


def test_every_date_key_is_in_its_dimension(sources):
    fact = build(sources, open_only=False)
    for column, table, ts in [
        ("payment_date_key", "payment", "payment_date"),
        ("rental_date_key", "rental", "rental_date"),
        ("return_date_key", "rental", "return_date"),
    ]:
        days = date_dim(sources[table], ts).select(F.col("date_key").alias(column))
        keys = fact.where(F.col(column).isNotNull())
        assert keys.count() > 0
        assert keys.join(days, column, "left_anti").count() == 0
