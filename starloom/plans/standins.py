"""The given tables in the roles of the thirteen source tables.

The given data has no rental schema. Each source table is a projection of a given
table of the same shape, so the builders run unchanged and their work grows with
the data. Orders are rentals, line items are payments, customers double as
addresses and inventory items, suppliers as staff, stores and categories, parts as
films.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# source table -> (given table, column expressions)
_STAND_INS: dict[str, tuple[str, tuple[str, ...]]] = {
    "payment": (
        "lineitem",
        (
            "l_orderkey * 8 + l_linenumber AS payment_id",
            "l_partkey AS customer_id",
            "l_suppkey AS staff_id",
            "l_orderkey AS rental_id",
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS amount",
            "l_shipdate AS payment_date",
        ),
    ),
    "rental": (
        "orders",
        (
            "o_orderkey AS rental_id",
            "o_custkey AS inventory_id",
            "o_orderdate AS rental_date",
            "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 7 DAYS END AS return_date",
        ),
    ),
    "inventory": (
        "customer",
        ("c_custkey AS inventory_id", "c_nationkey AS store_id", "c_custkey AS film_id"),
    ),
    "customer": (
        "customer",
        (
            "c_custkey AS customer_id",
            "c_custkey AS address_id",
            "c_name AS first_name",
            "c_mktsegment AS last_name",
            "lower(c_name) || '@' || lower(c_mktsegment) AS email",
            "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 "
            "WHEN c_mktsegment <> 'MACHINERY' THEN 0 END AS active",
            "TIMESTAMP_NTZ '1995-01-01' + make_dt_interval(c_nationkey, c_nationkey) "
            "AS create_date",
        ),
    ),
    "staff": (
        "supplier",
        (
            "s_suppkey AS staff_id",
            "s_suppkey AS address_id",
            "s_name AS first_name",
            "'Nation ' || s_nationkey AS last_name",
            "lower(s_name) AS email",
            "s_acctbal >= 5000 AS active",
        ),
    ),
    "store": (
        "supplier",
        (
            "s_suppkey AS store_id",
            "CAST(s_nationkey AS BIGINT) AS manager_staff_id",
            "s_suppkey AS address_id",
        ),
    ),
    "address": (
        "customer",
        (
            "c_custkey AS address_id",
            "c_nationkey AS city_id",
            "c_name AS address",
            "CASE WHEN c_acctbal >= 5000 THEN c_mktsegment END AS address2",
            "nullif(c_mktsegment, 'FURNITURE') AS district",
            "CAST(c_nationkey AS STRING) AS postal_code",
            "CAST(c_custkey AS STRING) AS phone",
        ),
    ),
    "city": (
        "nation",
        ("n_nationkey AS city_id", "n_regionkey AS country_id", "n_name AS city"),
    ),
    "country": ("region", ("r_regionkey AS country_id", "r_name AS country")),
    "film": (
        "part",
        (
            "p_partkey AS film_id",
            "p_brand AS language_id",
            "p_name AS title",
            "p_type AS description",
            "p_size + 1970 AS release_year",
            "p_size AS rental_duration",
            "CAST(p_size AS DECIMAL(4,2)) AS rental_rate",
            "p_size * 3 AS length",
            "replace(p_brand, 'Brand', '') AS rating",
            "split(p_name, ' ') AS special_features",
        ),
    ),
    "language": ("part", ("p_brand AS language_id", "p_brand AS name")),
    "film_category": ("lineitem", ("l_partkey AS film_id", "l_suppkey AS category_id")),
    "category": ("supplier", ("s_suppkey AS category_id", "s_name AS name")),
}
# Stand-ins whose given table repeats the pairs they need.
_DISTINCT = {"language", "film_category"}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class SourceTables(Mapping[str, DataFrame]):
    """The thirteen source tables, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            table, expressions = _STAND_INS[name]
            df = given(self._spark, self._sf_dir, table).selectExpr(*expressions)
            self._read[name] = df.distinct() if name in _DISTINCT else df
        return self._read[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_STAND_INS)

    def __len__(self) -> int:
        return len(_STAND_INS)


def source_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    return SourceTables(spark, sf_dir)
