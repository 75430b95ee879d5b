"""Thirteen small source tables that hold the edge rows."""

from datetime import datetime as dt
from decimal import Decimal as D

SCHEMAS = {
    "payment": "payment_id int, customer_id smallint, staff_id smallint, rental_id int, "
    "amount decimal(12,2), payment_date timestamp",
    "rental": "rental_id int, inventory_id int, rental_date timestamp, return_date timestamp",
    "inventory": "inventory_id int, store_id smallint, film_id smallint",
    "customer": "customer_id smallint, address_id int, first_name string, last_name string, "
    "email string, active int, create_date timestamp",
    "staff": "staff_id smallint, address_id int, first_name string, last_name string, "
    "email string, active boolean",
    "store": "store_id smallint, manager_staff_id smallint, address_id int",
    "address": "address_id int, city_id int, address string, address2 string, district string, "
    "postal_code string, phone string",
    "city": "city_id int, country_id int, city string",
    "country": "country_id int, country string",
    "film": "film_id smallint, language_id int, title string, description string, "
    "release_year smallint, rental_duration smallint, rental_rate decimal(4,2), "
    "length smallint, rating string, special_features array<string>",
    "language": "language_id int, name string",
    "film_category": "film_id smallint, category_id int",
    "category": "category_id int, name string",
}

ROWS = {
    "country": [(1, "Norway"), (2, "Peru")],
    "city": [(1, 1, "Oslo"), (2, 2, "Lima"), (3, 9, "Atlantis")],
    "address": [
        (1, 1, "1 North St", None, "East", "0150", "111"),
        (2, 2, "2 South St", "Flat 2", "West", None, "222"),
        (3, 3, "3 Sunken St", None, "Deep", "9", "333"),
        (4, None, "4 Lost St", None, "None", "9", "444"),
    ],
    "customer": [
        (1, 1, "Ann", "One", "ann@x.org", 1, dt(2005, 5, 1, 10)),
        (2, 2, "Bob", "Two", None, 0, dt(2005, 5, 2, 10)),
        (3, 2, "Cid", "Three", "cid@x.org", None, dt(2005, 5, 3, 10)),
        (4, 3, "Dan", "NoCountry", None, 1, dt(2005, 5, 4, 10)),
        (5, 4, "Eve", "NoCity", None, 1, dt(2005, 5, 5, 10)),
        (6, 99, "Fay", "NoAddress", None, 1, dt(2005, 5, 6, 10)),
        (7, None, "Gus", "NullAddress", None, 1, dt(2005, 5, 7, 10)),
    ],
    "staff": [
        (1, 1, "Mike", "Manager", "mike@x.org", True),
        (2, 2, "Jon", "Clerk", "jon@x.org", None),
        (3, 99, "Lia", "Remote", "lia@x.org", False),
    ],
    "store": [(1, 1, 1), (2, 3, 2), (3, None, 1), (4, 77, 2)],
    "language": [(1, "English"), (2, "French")],
    "category": [(1, "Action"), (2, "Comedy")],
    "film": [
        (1, 1, "First", "A film", 2005, 3, D("2.99"), 90, "PG", ["A b", "C", None]),
        (2, 2, "Second", "Two kinds", 2006, 5, D("0.99"), 120, "NC-17", []),
        (3, 1, "Third", "No kind", 2006, 5, D("4.99"), 100, "G", None),
        (4, 9, "Fourth", "No language", 2006, 5, D("4.99"), 100, "G", ["X"]),
    ],
    "film_category": [(1, 1), (2, 1), (2, 2), (4, 1), (1, 9)],
    "inventory": [(1, 1, 1), (2, 2, 2), (3, 1, 2)],
    "rental": [
        (1, 1, dt(2005, 5, 24, 10), None),
        (2, 2, dt(2005, 5, 24, 23, 59, 59), dt(2005, 5, 28, 9)),
        (3, 3, dt(2005, 5, 29, 1), None),
        (4, 99, dt(2005, 5, 30, 1), None),
        (5, None, None, None),
    ],
    "payment": [
        (1, 1, 1, 1, D("2.99"), dt(2005, 5, 24, 11)),
        (2, 2, 1, 2, D("0.99"), dt(2005, 5, 28, 9)),
        (3, 1, 2, 1, D("1.00"), dt(2005, 6, 1, 0)),
        (4, 3, 2, 3, D("4.99"), None),
        (5, 3, 2, 4, D("4.99"), dt(2005, 6, 2, 0)),
        (6, 3, 2, 88, D("4.99"), dt(2005, 6, 3, 0)),
        (7, 3, 2, None, D("4.99"), dt(2005, 6, 4, 0)),
    ],
}


def make_sources(spark):
    return {t: spark.createDataFrame(ROWS[t], SCHEMAS[t]) for t in SCHEMAS}
