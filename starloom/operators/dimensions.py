"""Dimension builders: DataFrame in, DataFrame out, nothing run unless the join probes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar_columns
from starloom.functions.dates import DEFAULT_KEY_PATTERN
from starloom.operators.joins import Join, declared_join


def flatten_geography(
    address: DataFrame, city: DataFrame, country: DataFrame, join: Join = declared_join
) -> DataFrame:
    """address, city and country as one frame per address.

    City and country are joined first: both stay narrow, and the entity that uses
    the result is shuffled by address only, never by city.
    """
    places = join(
        city.select("city_id", "country_id", "city"),
        country.select("country_id", "country"),
        "country_id",
        "country",
    ).drop("country_id")
    addresses = address.select(
        "address_id", "city_id", "address", "address2", "district", "postal_code", "phone"
    )
    return join(addresses, places, "city_id", "places").drop("city_id")


_ADDRESS = ["address", "address2", "district", "city", "country", "postal_code"]


def dim_customer(customer: DataFrame, geography: DataFrame, join: Join = declared_join) -> DataFrame:
    """One row per customer with a complete address; any ``active`` but 1 is false."""
    located = join(
        customer.select(
            "customer_id", "address_id", "first_name", "last_name", "email", "active", "create_date"
        ),
        geography,
        "address_id",
        "geography",
    )
    return located.select(
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        "first_name",
        "last_name",
        "email",
        *_ADDRESS,
        "phone",
        F.when(F.col("active") == 1, F.lit(True)).otherwise(F.lit(False)).alias("active"),
        "create_date",
    )


def dim_staff(staff: DataFrame, geography: DataFrame, join: Join = declared_join) -> DataFrame:
    """One row per staff member with a complete address."""
    located = join(
        staff.select("staff_id", "address_id", "first_name", "last_name", "email", "active"),
        geography,
        "address_id",
        "geography",
    )
    return located.select(
        F.col("staff_id").alias("staff_key"),
        "staff_id",
        "first_name",
        "last_name",
        "email",
        *_ADDRESS,
        "phone",
        "active",
    )


def dim_store(
    store: DataFrame, staff: DataFrame, geography: DataFrame, join: Join = declared_join
) -> DataFrame:
    """One row per store that has a manager and a complete address."""
    managers = staff.select(
        F.col("staff_id").alias("manager_staff_id"),
        F.col("first_name").alias("manager_first_name"),
        F.col("last_name").alias("manager_last_name"),
    )
    managed = join(
        store.select("store_id", "manager_staff_id", "address_id"),
        managers,
        "manager_staff_id",
        "managers",
    )
    return join(managed, geography, "address_id", "geography").select(
        F.col("store_id").alias("store_key"),
        "store_id",
        *_ADDRESS,
        "manager_first_name",
        "manager_last_name",
    )


def dim_movie(
    film: DataFrame,
    language: DataFrame,
    film_category: DataFrame,
    category: DataFrame,
    join: Join = declared_join,
) -> DataFrame:
    """One row per film and category; a film in two categories gives two rows."""
    films = join(
        film.select(
            "film_id",
            "language_id",
            "title",
            "description",
            "release_year",
            "rental_duration",
            "rental_rate",
            "length",
            "rating",
            F.col("special_features").cast("string").alias("special_features"),
        ),
        language.select("language_id", F.col("name").alias("language")),
        "language_id",
        "language",
    )
    categories = join(
        film_category.select("film_id", "category_id"),
        category.select("category_id", F.col("name").alias("category")),
        "category_id",
        "category",
    )
    return join(categories, films, "film_id", "films").select(
        F.col("film_id").alias("movie_key"),
        "film_id",
        "title",
        "description",
        "release_year",
        "language",
        "rental_duration",
        "rental_rate",
        "length",
        "rating",
        "category",
        "special_features",
    )


def date_dim(
    df: DataFrame,
    ts_col: str | Column,
    pattern: str = DEFAULT_KEY_PATTERN,
    as_text: bool = False,
) -> DataFrame:
    """One row per calendar day present in a timestamp column; NULLs are skipped.

    The days are made distinct first and the other columns derived after, so the
    shuffle moves one date per day and task however many rows a day has.
    """
    ts = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    days = df.where(ts.isNotNull()).select(ts.cast("date").alias("d")).distinct()
    return days.select(*calendar_columns(F.col("d"), pattern, as_text))
