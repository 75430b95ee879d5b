"""DuckDB SQL for the registered queries, over the same given tables."""

from __future__ import annotations

# The thirteen source tables, as the stand-ins define them.
SOURCES = """
payment AS (
  SELECT l_orderkey * 8 + l_linenumber AS payment_id, l_partkey AS customer_id,
         l_suppkey AS staff_id, l_orderkey AS rental_id,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, l_shipdate AS payment_date
  FROM lineitem),
rental AS (
  SELECT o_orderkey AS rental_id, o_custkey AS inventory_id, o_orderdate AS rental_date,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 7 DAY END AS return_date
  FROM orders),
inventory AS (
  SELECT c_custkey AS inventory_id, c_nationkey AS store_id, c_custkey AS film_id FROM customer),
cust AS (
  SELECT c_custkey AS customer_id, c_custkey AS address_id, c_name AS first_name,
         c_mktsegment AS last_name, lower(c_name) || '@' || lower(c_mktsegment) AS email,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 1
              WHEN c_mktsegment <> 'MACHINERY' THEN 0 END AS active,
         TIMESTAMP '1995-01-01' + to_days(c_nationkey) + to_hours(c_nationkey) AS create_date
  FROM customer),
staff AS (
  SELECT s_suppkey AS staff_id, s_suppkey AS address_id, s_name AS first_name,
         'Nation ' || s_nationkey AS last_name, lower(s_name) AS email,
         s_acctbal >= 5000 AS active
  FROM supplier),
store AS (
  SELECT s_suppkey AS store_id, CAST(s_nationkey AS BIGINT) AS manager_staff_id,
         s_suppkey AS address_id
  FROM supplier),
address AS (
  SELECT c_custkey AS address_id, c_nationkey AS city_id, c_name AS address,
         CASE WHEN c_acctbal >= 5000 THEN c_mktsegment END AS address2,
         nullif(c_mktsegment, 'FURNITURE') AS district,
         CAST(c_nationkey AS VARCHAR) AS postal_code, CAST(c_custkey AS VARCHAR) AS phone
  FROM customer),
city AS (
  SELECT n_nationkey AS city_id, n_regionkey AS country_id, n_name AS city FROM nation),
country AS (SELECT r_regionkey AS country_id, r_name AS country FROM region),
film AS (
  SELECT p_partkey AS film_id, p_brand AS language_id, p_name AS title, p_type AS description,
         p_size + 1970 AS release_year, p_size AS rental_duration,
         CAST(p_size AS DECIMAL(4,2)) AS rental_rate, p_size * 3 AS length,
         replace(p_brand, 'Brand', '') AS rating, string_split(p_name, ' ') AS special_features
  FROM part),
language AS (SELECT DISTINCT p_brand AS language_id, p_brand AS name FROM part),
film_category AS (
  SELECT DISTINCT l_partkey AS film_id, l_suppkey AS category_id FROM lineitem),
category AS (SELECT s_suppkey AS category_id, s_name AS name FROM supplier)
"""

_PLACE = "a.address, a.address2, a.district, ci.city, co.country, a.postal_code"
_GEOGRAPHY = """
  JOIN address a ON e.address_id = a.address_id
  JOIN city ci ON a.city_id = ci.city_id
  JOIN country co ON ci.country_id = co.country_id"""


def date_dim_sql(table: str, ts: str, as_text: bool = False) -> str:
    key = f"strftime({ts}, '%y%m%d')"
    weekend = f"isodow({ts}) IN (6, 7)"
    return f"""
SELECT DISTINCT {key if as_text else f"CAST({key} AS INTEGER)"} AS date_key,
       CAST({ts} AS DATE) AS date,
       CAST(year({ts}) AS INTEGER) AS year, CAST(quarter({ts}) AS INTEGER) AS quarter,
       year({ts}) || 'Q' || quarter({ts}) AS year_quart,
       CAST(month({ts}) AS INTEGER) AS month, CAST(day({ts}) AS INTEGER) AS day,
       CAST(week({ts}) AS INTEGER) AS week,
       {f"CASE WHEN {weekend} THEN 'true' ELSE 'false' END" if as_text else weekend} AS is_weekend
FROM {table} WHERE {ts} IS NOT NULL"""


DIM_CUSTOMER = f"""
SELECT e.customer_id AS customer_key, e.customer_id, e.first_name, e.last_name, e.email,
       {_PLACE}, a.phone,
       CASE WHEN e.active = 1 THEN true ELSE false END AS active, e.create_date
FROM cust e {_GEOGRAPHY}"""

DIM_STAFF = f"""
SELECT e.staff_id AS staff_key, e.staff_id, e.first_name, e.last_name, e.email,
       {_PLACE}, a.phone, e.active
FROM staff e {_GEOGRAPHY}"""

DIM_STORE = f"""
SELECT e.store_id AS store_key, e.store_id, {_PLACE},
       m.first_name AS manager_first_name, m.last_name AS manager_last_name
FROM store e JOIN staff m ON e.manager_staff_id = m.staff_id {_GEOGRAPHY}"""

DIM_MOVIE = """
SELECT f.film_id AS movie_key, f.film_id, f.title, f.description, f.release_year,
       l.name AS language, f.rental_duration, f.rental_rate, f.length, f.rating,
       c.name AS category, CAST(f.special_features AS VARCHAR) AS special_features
FROM film f
JOIN language l ON f.language_id = l.language_id
JOIN film_category fc ON f.film_id = fc.film_id
JOIN category c ON fc.category_id = c.category_id"""


def fact_sql(open_only: bool) -> str:
    return f"""
SELECT p.payment_id AS sales_key,
       CAST(strftime(p.payment_date, '%y%m%d') AS INTEGER) AS payment_date_key,
       CAST(strftime(r.rental_date, '%y%m%d') AS INTEGER) AS rental_date_key,
       CAST(strftime(r.return_date, '%y%m%d') AS INTEGER) AS return_date_key,
       p.customer_id AS customer_key, p.staff_id AS staff_key,
       i.store_id AS store_key, i.film_id AS movie_key, p.amount AS sales_amount
FROM payment p
JOIN rental r ON p.rental_id = r.rental_id
JOIN inventory i ON r.inventory_id = i.inventory_id
{"WHERE r.return_date IS NULL" if open_only else ""}"""


TARGETS = {
    "dim_payment_date": date_dim_sql("payment", "payment_date"),
    "dim_rental_date": date_dim_sql("rental", "rental_date"),
    "dim_return_date": date_dim_sql("rental", "return_date"),
    "dim_customer": DIM_CUSTOMER,
    "dim_movie": DIM_MOVIE,
    "dim_staff": DIM_STAFF,
    "dim_store": DIM_STORE,
    "fact_sales": fact_sql(open_only=False),
}


def over_sources(select: str) -> str:
    return f"WITH {SOURCES} {select}"


def over_targets(select: str) -> str:
    targets = ", ".join(f"{name} AS ({sql})" for name, sql in TARGETS.items())
    return f"WITH {SOURCES}, {targets} {select}"


# Written out by hand rather than derived from the contracts, so that the two can disagree.
NOT_NULL = {
    "dim_payment_date": "date_key date year quarter year_quart month day week",
    "dim_rental_date": "date_key date year quarter year_quart month day week",
    "dim_return_date": "date_key date year quarter year_quart month day week",
    "dim_customer": "customer_key customer_id first_name last_name address district city country "
    "phone active create_date",
    "dim_movie": "movie_key film_id title description release_year language rental_duration "
    "rental_rate length rating category special_features",
    "dim_staff": "staff_key staff_id first_name last_name address district city country phone "
    "active",
    "dim_store": "store_key store_id address district city country manager_first_name "
    "manager_last_name",
    "fact_sales": "sales_key",
}
_PLACE_LENGTHS = {
    "address": 50,
    "address2": 50,
    "district": 20,
    "city": 50,
    "country": 50,
    "postal_code": 10,
}
_PERSON_LENGTHS = {"first_name": 45, "last_name": 45, "email": 50}
LENGTHS = {
    "dim_customer": {**_PERSON_LENGTHS, **_PLACE_LENGTHS, "phone": 20},
    "dim_movie": {
        "title": 255,
        "language": 20,
        "rating": 5,
        "category": 15,
        "special_features": 60,
    },
    "dim_staff": {**_PERSON_LENGTHS, **_PLACE_LENGTHS, "phone": 20},
    "dim_store": {**_PLACE_LENGTHS, "manager_first_name": 45, "manager_last_name": 45},
}
KEYS = {
    "dim_payment_date": "date_key",
    "dim_rental_date": "date_key",
    "dim_return_date": "date_key",
    "dim_customer": "customer_key",
    "dim_movie": "movie_key",
    "dim_staff": "staff_key",
    "dim_store": "store_key",
    "fact_sales": "sales_key",
}
FOREIGN_KEYS = {
    "payment_date_key": "dim_payment_date",
    "rental_date_key": "dim_rental_date",
    "return_date_key": "dim_return_date",
    "customer_key": "dim_customer",
    "staff_key": "dim_staff",
    "store_key": "dim_store",
    "movie_key": "dim_movie",
}


def _report(table: str, check: str, column: str, violations: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
        f"CAST(({violations}) AS BIGINT) AS violations"
    )


def not_empty_sql() -> str:
    return over_targets(
        " UNION ALL ".join(
            _report(t, "not_empty", "*", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {t}")
            for t in TARGETS
        )
    )


def not_null_sql() -> str:
    return over_targets(
        " UNION ALL ".join(
            _report(t, "not_null", c, f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
            for t, columns in NOT_NULL.items()
            for c in columns.split()
        )
    )


def length_sql() -> str:
    return over_targets(
        " UNION ALL ".join(
            _report(t, "length", c, f"SELECT count(*) FROM {t} WHERE length({c}) > {n}")
            for t, limits in LENGTHS.items()
            for c, n in limits.items()
        )
    )


def unique_key_sql() -> str:
    return over_targets(
        " UNION ALL ".join(
            _report(
                t,
                "unique_key",
                k,
                f"SELECT count(*) FROM (SELECT {k} FROM {t} WHERE {k} IS NOT NULL "
                f"GROUP BY {k} HAVING count(*) > 1)",
            )
            for t, k in KEYS.items()
        )
    )


def foreign_keys_sql() -> str:
    return over_targets(
        " UNION ALL ".join(
            _report(
                "fact_sales",
                "foreign_key",
                c,
                f"SELECT count(*) FROM fact_sales f WHERE f.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {t} d WHERE d.{KEYS[t]} = f.{c})",
            )
            for c, t in FOREIGN_KEYS.items()
        )
    )


def row_counts_sql(open_only: bool = False) -> str:
    kept = {"fact_sales": "WHERE return_date_key IS NULL"} if open_only else {}
    return over_targets(
        " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS n FROM {t} {kept.get(t, '')}" for t in TARGETS
        )
    )


_CONFORMED_DATE = """
SELECT date_key, date, CAST(year AS SMALLINT) AS year, CAST(quarter AS SMALLINT) AS quarter,
       year_quart, CAST(month AS SMALLINT) AS month, CAST(day AS SMALLINT) AS day,
       CAST(week AS SMALLINT) AS week, is_weekend
FROM dim_rental_date"""

_CONFORMED_FACT = """
SELECT CAST(sales_key AS BIGINT) AS sales_key, payment_date_key, rental_date_key,
       return_date_key, CAST(customer_key AS BIGINT) AS customer_key,
       CAST(staff_key AS BIGINT) AS staff_key, CAST(store_key AS BIGINT) AS store_key,
       CAST(movie_key AS BIGINT) AS movie_key,
       CAST(sales_amount AS DECIMAL(12,2)) AS sales_amount
FROM fact_sales"""

_DROPPED = [
    ("customer", "address_id", "cust", "address"),
    ("staff", "address_id", "staff", "address"),
    ("store", "manager_staff_id", "store", "staff"),
    ("film", "film_id", "film", "film_category"),
    ("rental", "inventory_id", "rental", "inventory"),
    ("payment", "rental_id", "payment", "rental"),
    ("payment", "staff_id", "payment", "staff"),
    ("payment", "customer_id", "payment", "cust"),
]


def dropped_rows_sql() -> str:
    partner_key = {("store", "manager_staff_id"): "staff_id"}
    return over_sources(
        " UNION ALL ".join(
            f"SELECT '{name}' AS \"table\", '{key}' AS \"column\", count(*) AS dropped "
            f"FROM {left} l WHERE NOT EXISTS (SELECT 1 FROM {right} r "
            f"WHERE r.{partner_key.get((name, key), key)} = l.{key})"
            for name, key, left, right in _DROPPED
        )
    )


_CITY_RATINGS = """
SELECT city.city, film.rating, count(*) AS payments, sum(payment.amount) AS paid
FROM rental JOIN payment USING (rental_id) JOIN inventory USING (inventory_id)
JOIN film USING (film_id) JOIN cust ON cust.customer_id = payment.customer_id
JOIN address USING (address_id) JOIN city USING (city_id)
WHERE rental.return_date IS NULL GROUP BY ALL"""

_SKEWED = """
SELECT o.o_orderkey, l_partkey, l_linenumber, l_quantity, o_custkey, o_orderstatus FROM lineitem
JOIN orders o ON o.o_orderkey = CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_orderkey END"""


ORACLES: dict[str, str] = {
    **{name: over_sources(sql) for name, sql in TARGETS.items() if name != "fact_sales"},
    "dim_event_date": date_dim_sql("events", "ts"),
    "dim_rental_date_text": over_sources(date_dim_sql("rental", "rental_date", as_text=True)),
    "fact_sales_open": over_sources(fact_sql(open_only=True)),
    "fact_sales_all": over_sources(fact_sql(open_only=False)),
    "fact_sales_preview": over_sources(
        f"SELECT count(*) AS n FROM ({fact_sql(open_only=True)} LIMIT 10)"
    ),
    "sql_over_views": over_sources(_CITY_RATINGS),
    "dropped_rows": dropped_rows_sql(),
    "row_counts": row_counts_sql(),
    "check_not_empty": not_empty_sql(),
    "check_not_null": not_null_sql(),
    "check_unique_key": unique_key_sql(),
    "check_foreign_keys": foreign_keys_sql(),
    "check_length": length_sql(),
    "conformed_dim_rental_date": over_targets(_CONFORMED_DATE),
    "conformed_fact_sales": over_targets(_CONFORMED_FACT),
    "created_table": over_targets(_CONFORMED_DATE),
    "csv_round_trip": over_targets(_CONFORMED_FACT),
    "csv_round_trip_text": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "append_new_keys": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "append_repeated_keys": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem",
    "file_warehouse": over_targets(_CONFORMED_FACT),
    "fact_sales_cut": over_sources(
        fact_sql(open_only=False)
        + " WHERE p.payment_id <= (SELECT max(payment_id) // 2 FROM payment) AND r.rental_id <= (SELECT max(rental_id) // 2 FROM rental)"
        " AND i.inventory_id <= (SELECT max(inventory_id) // 2 FROM inventory)"
    ),
    "write_both_counts": over_targets(
        "SELECT 'extract' AS sink, count(*) AS n FROM fact_sales "
        "UNION ALL SELECT 'warehouse' AS sink, count(*) AS n FROM fact_sales"
    ),
    "write_both_rows": over_targets(
        f"SELECT s.*, k.sink FROM ({_CONFORMED_FACT}) s, (VALUES ('extract'), ('warehouse')) k(sink)"
    ),
    "load_star_counts": row_counts_sql(open_only=True),
    "load_star_twice": over_targets(_CONFORMED_FACT),
    "check_all": " UNION ALL ".join(
        f"SELECT * FROM ({sql()})"
        for sql in (not_empty_sql, not_null_sql, length_sql, unique_key_sql, foreign_keys_sql)
    ),
    "split_join": _SKEWED,
    "salted_join": _SKEWED,
}
