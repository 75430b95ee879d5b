"""Warehouse tables over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.contracts import Contract
from starloom.sources.jdbc import JdbcConnection

#: Statements run in one transaction.
Execute = Callable[[Sequence[str]], None]
#: The table in which published runs are noted, and the column that numbers a run's rows.
RUNS_TABLE, ROW_NUMBER = "loaded_runs", "run_row"


def in_transaction(spark: SparkSession, connection: JdbcConnection) -> Execute:
    """Runs statements over one connection from the driver; all or none take effect."""

    def execute(statements: Sequence[str]) -> None:
        jvm = spark._jvm
        options = jvm.java.util.Properties()
        for name in ("user", "password"):
            if getattr(connection, name) is not None:
                options.setProperty(name, getattr(connection, name))
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        opened = loader.loadClass(connection.driver).newInstance().connect(connection.url, options)
        try:
            opened.setAutoCommit(False)
            for statement in statements:
                opened.createStatement().execute(statement)
            opened.commit()
        finally:
            opened.close()  # rolls back what was not committed

    return execute


def warehouse_creator(execute: Execute, types: Mapping[str, str] | None = None) -> Callable[[Contract], None]:
    """Creates a contract's table where it is absent, as ``load_star`` calls it."""
    return lambda contract: execute([contract.warehouse_ddl(types)])


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def publish_statements(table: str, staged: str, columns: Sequence[str], run_id: str) -> list[str]:
    """The transaction that moves a run from its staging table to ``table``, unless it was moved before.

    A task that was run again has put the same rows there again, under the same numbers.
    """
    names, run = ", ".join(columns), f"{_text(run_id)}, {_text(table)}"
    absent = f"NOT EXISTS (SELECT 1 FROM {RUNS_TABLE} WHERE run_id = {_text(run_id)} AND target = {_text(table)})"
    return [
        f"INSERT INTO {table} ({names}) SELECT {names} FROM (SELECT DISTINCT {ROW_NUMBER}, {names} FROM {staged}) s WHERE {absent}",
        f"INSERT INTO {RUNS_TABLE} (run_id, target) SELECT {run} WHERE {absent}",
    ]


def publish_jdbc(
    df: DataFrame,
    connection: JdbcConnection,
    table: str,
    run_id: str,
    contract: Contract | None = None,
    execute: Execute | None = None,
    batch_size: int = 10_000,
    max_connections: int | None = None,
) -> None:
    """Append the rows of a run to an existing table in two steps, so that they become visible at once, and once.

    The rows go to a staging table of the run, which an attempt replaces; then one transaction
    inserts each of them once into ``table`` and notes the run. Repeating a run, at any
    point, adds nothing. ``df`` must give the same rows when a task is run again, as a staged
    frame does; its rows are numbered by task and place.
    """
    execute = execute or in_transaction(df.sparkSession, connection)
    staged = f"{table}_run_{''.join(c if c.isalnum() else '_' for c in run_id)}"
    execute([f"CREATE TABLE IF NOT EXISTS {RUNS_TABLE} (run_id varchar(200), target varchar(200), PRIMARY KEY (run_id, target))"])
    options = connection.options(
        dbtable=staged,
        batchsize=batch_size,
        numPartitions=max_connections,
        createTableColumnTypes=(contract.jdbc_column_types() if contract else "") or None,
    )
    numbered = df.withColumn(ROW_NUMBER, F.monotonically_increasing_id())
    numbered.write.format("jdbc").options(**options).mode("overwrite").save()
    execute(publish_statements(table, staged, df.columns, run_id))
    execute([f"DROP TABLE {staged}"])


def jdbc_publisher(
    connection: JdbcConnection,
    run_id: str,
    contracts: Mapping[str, Contract] | None = None,
    execute: Execute | None = None,
    max_connections: int | None = None,
) -> Callable[[str, DataFrame], None]:
    """``publish_jdbc`` bound to a warehouse and a run, as the sink of a load."""

    def publish(table: str, df: DataFrame) -> None:
        publish_jdbc(df, connection, table, run_id, (contracts or {}).get(table), execute, max_connections=max_connections)

    return publish


def append_jdbc(
    df: DataFrame,
    connection: JdbcConnection,
    table: str,
    contract: Contract | None = None,
    batch_size: int = 10_000,
    max_connections: int | None = None,
) -> None:
    """Append to a table, which Spark creates if it is absent.

    With a contract a new table gets the declared text lengths. ``max_connections``
    bounds how many tasks insert at once. Each task commits on its own, so a failed
    load can be partial, and a task that is run again can insert twice: ``publish_jdbc``
    can do neither.
    """
    column_types = contract.jdbc_column_types() if contract else ""
    options = connection.options(
        dbtable=table,
        batchsize=batch_size,
        numPartitions=max_connections,
        createTableColumnTypes=column_types or None,
    )
    df.write.format("jdbc").options(**options).mode("append").save()


def jdbc_appender(
    connection: JdbcConnection,
    contracts: Mapping[str, Contract] | None = None,
    max_connections: int | None = None,
) -> Callable[[str, DataFrame], None]:
    """``append_jdbc`` bound to a warehouse, as the sink of a load."""

    def append(table: str, df: DataFrame) -> None:
        contract = contracts.get(table) if contracts else None
        append_jdbc(df, connection, table, contract, max_connections=max_connections)

    return append
