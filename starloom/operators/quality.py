"""Data checks over the built tables.

Every report has the columns (table, check, column, violations bigint) and one row
per declared constraint, also where nothing is wrong.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.contracts import Contract


class CheckFailed(ValueError):
    """A table broke a check."""


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, n)`` for each frame."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
            for name, df in frames.items()
        ]
    )


def require_not_empty(frames: Mapping[str, DataFrame]) -> None:
    """Raise for the first frame, in the given order, that has no row.

    Only existence matters here, so each table stops at its first row.
    """
    for name, df in frames.items():
        if df.isEmpty():
            raise CheckFailed(f"table {name} has no records")


def check_not_empty(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One violation for each frame without rows; each stops at its first row."""
    first = {name: df.select(F.lit(1).alias("one")).limit(1) for name, df in frames.items()}
    return _row_checks(first, {name: _not_empty() for name in frames})


def check_not_null(
    frames: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """NULLs per column declared NOT NULL, all columns of a table in one pass."""
    return _row_checks(frames, {name: _not_null(contracts[name]) for name in frames})


def check_length(frames: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """Texts longer than their declared varchar, all columns of a table in one pass."""
    return _row_checks(frames, {name: _length(contracts[name]) for name in frames})


def check_unique_key(
    frames: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """Key values that occur more than once; equal keys are combined before the shuffle."""
    reports = []
    for name, df in frames.items():
        key = contracts[name].key
        per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        reports.append(
            _as_rows(
                per_key.agg(F.count_if(F.col("n") > 1).alias("repeated")),
                name,
                [("unique_key", key, "repeated")],
            )
        )
    return _union(reports)


def check_foreign_keys(
    frames: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """Rows whose non-NULL foreign key is missing in the referenced table.

    All foreign keys of a table are checked in one scan: they are unpivoted and
    counted per (column, key), so a hot key leaves each task as a single row, and
    one join with the keys of all referenced tables finds the orphans.
    """
    reports = []
    for name, df in frames.items():
        references = [(c, t) for c, t in contracts[name].references if t in frames]
        if not references:
            continue
        keys = df.select(*[F.col(c).cast("bigint").alias(c) for c, _ in references])
        counted = (
            keys.unpivot([], [c for c, _ in references], "column", "k")
            .where(F.col("k").isNotNull())
            .groupBy("column", "k")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        known = _union(
            [
                frames[t].select(
                    F.lit(c).alias("column"), F.col(contracts[t].key).cast("bigint").alias("k")
                )
                for c, t in references
            ]
        ).distinct()
        orphans = counted.join(known, ["column", "k"], "left_anti")
        totals = orphans.agg(
            *[F.sum(F.when(F.col("column") == c, F.col("n"))).alias(c) for c, _ in references]
        )
        reports.append(_as_rows(totals, name, [("foreign_key", c, c) for c, _ in references]))
    return _union(reports)


def check_all(frames: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """All five checks in one report; those that look at single rows share one pass per table."""
    rules = {
        name: _not_empty() + _not_null(contracts[name]) + _length(contracts[name])
        for name in frames
    }
    return _union(
        [
            _row_checks(frames, rules),
            check_unique_key(frames, contracts),
            check_foreign_keys(frames, contracts),
        ]
    )


def require_clean(report: DataFrame) -> None:
    """Raise with every broken constraint; a report has one row per constraint."""
    broken = report.where(F.col("violations") > 0).orderBy("table", "check", "column").collect()
    if broken:
        raise CheckFailed(
            "; ".join(f"{r['table']}.{r['column']}: {r['check']} ({r['violations']})" for r in broken)
        )


# (check, column, SQL aggregate that counts the violations)
Rule = tuple[str, str, str]


def _not_empty() -> list[Rule]:
    return [("not_empty", "*", "IF(count(*) = 0, 1L, 0L)")]


def _not_null(contract: Contract) -> list[Rule]:
    return [
        ("not_null", f.name, f"count_if(`{f.name}` IS NULL)")
        for f in contract.fields
        if not f.nullable
    ]


def _length(contract: Contract) -> list[Rule]:
    return [
        ("length", f.name, f"count_if(char_length(`{f.name}`) > {f.length})")
        for f in contract.fields
        if f.length
    ]


def _row_checks(frames: Mapping[str, DataFrame], rules: Mapping[str, list[Rule]]) -> DataFrame:
    """All rules of a table as one aggregate, turned into one row per rule."""
    return _union(
        [
            _as_rows(
                df.selectExpr(*[f"{rule[2]} AS v{i}" for i, rule in enumerate(rules[name])]),
                name,
                [(check, column, f"v{i}") for i, (check, column, _) in enumerate(rules[name])],
            )
            for name, df in frames.items()
            if rules[name]
        ]
    )


def _as_rows(totals: DataFrame, table: str, named: list[Rule]) -> DataFrame:
    """One row of totals as report rows; ``named`` gives check, column and total of each."""
    rows = ", ".join(
        f"struct('{table}' AS `table`, '{check}' AS `check`, '{column}' AS `column`, "
        f"coalesce(`{total}`, 0L) AS violations)"
        for check, column, total in named
    )
    return totals.selectExpr(f"inline(array({rows}))")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
