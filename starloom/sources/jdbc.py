"""Relational source tables over JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcConnection:
    """Where and how to connect; the password is kept out of ``repr``."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)

    def options(self, **extra: object) -> dict[str, str]:
        known = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {k: str(v) for k, v in {**known, **extra}.items() if v is not None}


@dataclass(frozen=True)
class KeyRange:
    """An integer, date or timestamp column and its bounds, read in equal strides.

    Rows outside the bounds are still read, by the first and last task. The strides
    are even in key values, so choose a column that is spread evenly, as a generated
    id is.
    """

    column: str
    lower: object
    upper: object
    partitions: int


def read_jdbc_table(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    split: KeyRange | Sequence[str] | None = None,
    fetch_size: int = 10_000,
    single_task: bool = False,
) -> DataFrame:
    """A whole table, by the strides of a ``KeyRange`` or by one task per predicate.

    Without either the table would be read by one task; ``single_task`` says so on purpose.
    Column pruning, filters and counts are pushed into the database by Spark.
    """
    if split is None and not single_task:
        raise ValueError(f"give a key range or predicates for {table}, or single_task=True")
    if isinstance(split, Sequence):
        properties = connection.options(fetchsize=fetch_size)
        url = properties.pop("url")
        return spark.read.jdbc(url, table, predicates=list(split), properties=properties)
    extra: dict[str, object] = {"dbtable": table, "fetchsize": fetch_size}
    if split is not None:
        extra.update(
            partitionColumn=split.column,
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.partitions,
        )
    return spark.read.format("jdbc").options(**connection.options(**extra)).load()


def key_range(
    spark: SparkSession,
    connection: JdbcConnection,
    table: str,
    column: str,
    max_tasks: int,
    rows_per_task: int = 1_000_000,
) -> KeyRange | None:
    """Bounds and task count for a read in even strides, from one aggregate in the database.

    ``max_tasks`` is the number of connections the database may see at once; with more rows
    than that many tasks' worth, tasks grow. None is returned for an empty table.
    """
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {table}"
    # drivers differ in the case of unquoted names, so the row is read by position
    lower, upper, rows = (
        spark.read.format("jdbc").options(**connection.options(query=query)).load().first()
    )
    if lower is None:
        return None
    tasks = min(max_tasks, max(1, -(-int(rows) // rows_per_task)))
    return KeyRange(column, lower, upper, tasks)


def highest_key(spark: SparkSession, connection: JdbcConnection, table: str, column: str) -> object:
    """The largest key of a table, found by the database; None if it is empty. For ``load_star(highest=...)``."""
    query = f"SELECT MAX({column}) AS hi FROM {table}"
    return spark.read.format("jdbc").options(**connection.options(query=query)).load().first()[0]


def key_predicates(
    spark: SparkSession, connection: JdbcConnection, table: str, column: str, tasks: int
) -> list[str]:
    """Predicates that cut a table by the quantiles of a numeric column, for clustered or gappy keys.

    The database ranks the column once. Each row, also one whose key is NULL, fits one
    predicate; a key with more rows than a task's share gets one of its own.
    """
    query = (
        f"SELECT MAX(k) AS hi FROM (SELECT {column} AS k, NTILE({tasks}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} WHERE {column} IS NOT NULL) q GROUP BY part"
    )
    found = spark.read.format("jdbc").options(**connection.options(query=query)).load().collect()
    cuts = sorted({row[0] for row in found})[:-1]
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} <= {cuts[0]} OR {column} IS NULL", *between, f"{column} > {cuts[-1]}"]
