"""Declared shape of the eight targets and the cast of a result to it."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """``type`` is a SQL type name; ``varchar(n)`` is text with a length limit."""

    name: str
    type: str
    nullable: bool = True

    @property
    def length(self) -> int | None:
        match = re.fullmatch(r"varchar\((\d+)\)", self.type)
        return int(match.group(1)) if match else None

    @property
    def spark_type(self) -> str:
        return "string" if self.length else self.type


@dataclass(frozen=True)
class Contract:
    """``references`` maps a foreign-key column to the table whose key it holds.

    ``fan_out`` names the columns that tell rows of one key apart, where a key can have several.
    """

    table: str
    key: str
    fields: tuple[Field, ...]
    references: tuple[tuple[str, str], ...] = ()
    fan_out: tuple[str, ...] = ()

    def schema(self) -> T.StructType:
        """Column types and nullability; needs a running session to parse them."""
        return T.StructType.fromDDL(
            ", ".join(
                f"`{f.name}` {f.spark_type}{'' if f.nullable else ' NOT NULL'}" for f in self.fields
            )
        )

    def ddl(self) -> str:
        """Column list with the declared lengths, for CREATE TABLE."""
        return ", ".join(
            f"`{f.name}` {f.type}{'' if f.nullable else ' NOT NULL'}" for f in self.fields
        )

    def jdbc_column_types(self) -> str:
        """Value of the ``createTableColumnTypes`` option: only the text with a length."""
        return ", ".join(f"{f.name} {f.type}" for f in self.fields if f.length)

    def warehouse_ddl(self, types: Mapping[str, str] | None = None) -> str:
        """CREATE TABLE text for a relational warehouse, with NOT NULL and both kinds of keys.

        ``types`` gives a dialect's names of Spark's types; ``WAREHOUSE_TYPES`` is the
        default. A referenced table must be created first: ``CONTRACTS`` is in such an order.
        A key that can have several rows is no primary key by itself, and a relational foreign
        key cannot point at it, so such a reference stays out of the text.
        """
        names = WAREHOUSE_TYPES if types is None else types
        columns = [
            f"{f.name} {names.get(f.type, f.type)}{'' if f.nullable else ' NOT NULL'}" for f in self.fields
        ]
        keys = [f"PRIMARY KEY ({', '.join((self.key, *self.fan_out))})"]
        keys += [
            f"FOREIGN KEY ({c}) REFERENCES {t} ({CONTRACTS[t].key})" for c, t in self.references if not CONTRACTS[t].fan_out
        ]
        return f"CREATE TABLE IF NOT EXISTS {self.table} ({', '.join(columns + keys)})"

    def widened(self) -> Contract:
        """The same contract with 64-bit keys and ids.

        The declared key types end at 32,767 and 2,147,483,647; a source that has
        outgrown them would otherwise fail the cast.
        """
        keys = {self.key, *(c for c, _ in self.references)}
        fields = tuple(
            Field(f.name, "bigint", f.nullable)
            if f.type in ("int", "smallint") and (f.name in keys or f.name.endswith("_id"))
            and not f.name.endswith("date_key")
            else f
            for f in self.fields
        )
        return Contract(self.table, self.key, fields, self.references, self.fan_out)


# A warehouse's names of types, where they differ from Spark's.
WAREHOUSE_TYPES = {"string": "text", "int": "integer", "tinyint": "smallint", "double": "double precision"}

# Column names, types, lengths and nullability of the targets.
_PERSON = (
    Field("first_name", "varchar(45)", False),
    Field("last_name", "varchar(45)", False),
    Field("email", "varchar(50)"),
)
_PLACE = (
    Field("address", "varchar(50)", False),
    Field("address2", "varchar(50)"),
    Field("district", "varchar(20)", False),
    Field("city", "varchar(50)", False),
    Field("country", "varchar(50)", False),
    Field("postal_code", "varchar(10)"),
)
_CALENDAR = (
    Field("date_key", "int", False),
    Field("date", "date", False),
    Field("year", "smallint", False),
    Field("quarter", "smallint", False),
    Field("year_quart", "string", False),
    Field("month", "smallint", False),
    Field("day", "smallint", False),
    Field("week", "smallint", False),
    Field("is_weekend", "boolean"),
)

CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        Contract("dim_payment_date", "date_key", _CALENDAR),
        Contract("dim_rental_date", "date_key", _CALENDAR),
        Contract("dim_return_date", "date_key", _CALENDAR),
        Contract(
            "dim_customer",
            "customer_key",
            (
                Field("customer_key", "int", False),
                Field("customer_id", "smallint", False),
                *_PERSON,
                *_PLACE,
                Field("phone", "varchar(20)", False),
                Field("active", "boolean", False),
                Field("create_date", "timestamp", False),
            ),
        ),
        Contract(
            "dim_movie",
            "movie_key",
            (
                Field("movie_key", "int", False),
                Field("film_id", "smallint", False),
                Field("title", "varchar(255)", False),
                Field("description", "string", False),
                Field("release_year", "smallint", False),
                Field("language", "varchar(20)", False),
                Field("rental_duration", "smallint", False),
                Field("rental_rate", "decimal(4,2)", False),
                Field("length", "smallint", False),
                Field("rating", "varchar(5)", False),
                Field("category", "varchar(15)", False),
                Field("special_features", "varchar(60)", False),
            ),
            fan_out=("category",),
        ),
        Contract(
            "dim_staff",
            "staff_key",
            (
                Field("staff_key", "int", False),
                Field("staff_id", "smallint", False),
                *_PERSON,
                *_PLACE,
                Field("phone", "varchar(20)", False),
                Field("active", "boolean", False),
            ),
        ),
        Contract(
            "dim_store",
            "store_key",
            (
                Field("store_key", "int", False),
                Field("store_id", "smallint", False),
                *_PLACE,
                Field("manager_first_name", "varchar(45)", False),
                Field("manager_last_name", "varchar(45)", False),
            ),
        ),
        Contract(
            "fact_sales",
            "sales_key",
            (
                Field("sales_key", "int", False),
                Field("payment_date_key", "int"),
                Field("rental_date_key", "int"),
                Field("return_date_key", "int"),
                Field("customer_key", "int"),
                Field("staff_key", "int"),
                Field("store_key", "int"),
                Field("movie_key", "int"),
                Field("sales_amount", "decimal(12,2)"),
            ),
            references=(
                ("payment_date_key", "dim_payment_date"),
                ("rental_date_key", "dim_rental_date"),
                ("return_date_key", "dim_return_date"),
                ("customer_key", "dim_customer"),
                ("staff_key", "dim_staff"),
                ("store_key", "dim_store"),
                ("movie_key", "dim_movie"),
            ),
        ),
    )
}


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Select, cast and order the columns as declared; a value that does not fit raises.

    Only an ANSI session raises instead of casting to NULL, so another one is refused.
    """
    if df.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("conform needs spark.sql.ansi.enabled")
    return df.selectExpr(
        *[f"CAST(`{f.name}` AS {f.spark_type}) AS `{f.name}`" for f in contract.fields]
    )


def create_if_absent(
    spark: SparkSession, contract: Contract, name: str, location: str, source: str = "parquet"
) -> None:
    """Create an external catalog table for a contract; a second call does nothing.

    Spark enforces the declared varchar lengths on every insert into it.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({contract.ddl()}) USING {source} LOCATION '{location}'"
    )
