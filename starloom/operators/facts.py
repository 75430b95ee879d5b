"""The sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import date_key
from starloom.functions.dates import DEFAULT_KEY_PATTERN
from starloom.operators.joins import Join, declared_join


def fact_sales(
    payment: DataFrame,
    rental: DataFrame,
    inventory: DataFrame,
    open_only: bool = True,
    join: Join = declared_join,
    pattern: str = DEFAULT_KEY_PATTERN,
) -> DataFrame:
    """One row per payment whose rental and inventory item exist.

    ``open_only`` keeps payments on rentals that have no return date, so their
    return key is NULL; with False every payment is loaded. Timestamps become integer
    keys before anything is shuffled.

    Rental and inventory are joined first, which leaves payment, the largest table,
    one shuffle instead of two.
    """
    if open_only:
        rental = rental.where(F.col("return_date").isNull())
        return_key = F.lit(None).cast("int")
    else:
        return_key = date_key(F.col("return_date"), pattern)
    rentals = rental.select(
        "rental_id",
        "inventory_id",
        date_key(F.col("rental_date"), pattern).alias("rental_date_key"),
        return_key.alias("return_date_key"),
    )
    items = inventory.select("inventory_id", "store_id", "film_id")
    payments = payment.select(
        "rental_id",
        "payment_id",
        date_key(F.col("payment_date"), pattern).alias("payment_date_key"),
        "customer_id",
        "staff_id",
        "amount",
    )
    rented = join(rentals, items, "inventory_id", "items")
    paid = join(payments, rented, "rental_id", "rented")
    return paid.select(
        F.col("payment_id").alias("sales_key"),
        "payment_date_key",
        "rental_date_key",
        "return_date_key",
        F.col("customer_id").alias("customer_key"),
        F.col("staff_id").alias("staff_key"),
        F.col("store_id").alias("store_key"),
        F.col("film_id").alias("movie_key"),
        F.col("amount").alias("sales_amount"),
    )
