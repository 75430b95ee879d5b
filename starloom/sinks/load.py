"""Staging, loading into several sinks, and the key-deduplicated append."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.joins import is_small
from starloom.operators.quality import CheckFailed
from starloom.sources.session import scratch_folder, shared_folder


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """Print the schema and some rows; the rows shown come back as a frame, computed once."""
    df.printSchema()
    head = df.sparkSession.createDataFrame(df.limit(rows).collect(), df.schema)
    head.show(rows)
    return head


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and read it back.

    Everything that follows reads the same rows, a lost executor costs no recompute,
    and later scans are columnar with known sizes. The path belongs to one run, so a
    rerun replaces what a failed attempt left.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_both(df: DataFrame, staging_path: str, sinks: Iterable[Callable[[DataFrame], None]]) -> DataFrame:
    """Compute a result once and hand the same rows to every sink."""
    staged = stage(df, staging_path)
    for sink in sinks:
        sink(staged)
    return staged


def new_rows(new: DataFrame, existing: DataFrame, key: str, folder: str | None = None) -> DataFrame:
    """Rows of ``new`` that the target lacks: those of absent keys, and what repeated keys are short of.

    Of a key that ``new`` has n times and the target m times, n - m rows are new: first those that
    the target holds no equal of, row for row, which is what a broken load left out. Only where
    their number differs, because a row was changed since, are the first n - m of them taken in
    the order of all columns. NULL is a key like any other.

    The keys of both sides are counted in one shuffle; whole rows move only where keys are lacking,
    and if those are few, only their rows. Rows of keys that are absent or not repeated are never
    compared. ``new`` is read more than once, so pass a staged frame; ``folder`` (by default one
    below the shared folder, which stays) holds what is worked out about short keys.
    """
    folder = folder or f"{shared_folder(new.sparkSession)}/starloom/append-{uuid.uuid4().hex}"
    count = F.count(F.lit(1))
    sides = [df.select(F.col(key), F.lit(n).cast("bigint").alias("_n"), F.lit(1 - n).cast("bigint").alias("_m")) for n, df in ((1, new), (0, existing))]
    keys = sides[0].unionAll(sides[1]).groupBy(key).agg(F.sum("_n").alias("_n"), F.sum("_m").alias("_m"))
    lacking = keys.where("_n > _m").select(key, (F.col("_n") - F.col("_m")).alias("_need"), "_m")
    # Staged, here and below, so that the joins have a plain shuffle on both sides, which AQE can split at a hot key.
    lacking = stage(lacking, f"{folder}/lacking")
    absent, short = lacking.where("_m = 0").select(key), lacking.where("_m > 0").select(key, "_need")
    if absent.isEmpty():
        fresh = new.limit(0)
    else:  # the target is asked again by the append itself, for keys that have come since
        fresh = _matched(new, F.broadcast(absent), [key], "left_semi") if is_small(absent) else new
        fresh = _matched(fresh, existing.select(key).distinct(), [key], "left_anti")
    if short.isEmpty():
        return fresh
    columns = new.columns
    wanted = _matched(new, short, [key], "left_semi").groupBy(*columns).agg(count.alias("_n"))
    held = _matched(existing.select(*columns), short, [key], "left_semi").groupBy(*columns).agg(count.alias("_m"))
    unmet = F.col("_n") - F.coalesce("_m", F.lit(0))
    missing = stage(_matched(wanted, held, columns, "left").select(*columns, unmet.alias("_times")).where("_times > 0"), f"{folder}/missing")
    sums = stage(_matched(missing.groupBy(key).agg(F.sum("_times").alias("_all")), short, [key]), f"{folder}/sums")
    rows = _matched(missing, sums.where("_all = _need"), [key], "left_semi")
    other = sums.where("_all != _need").select(key, "_need")
    if not other.isEmpty():
        before = F.sum("_times").over(Window.partitionBy(key).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1))
        taken = F.least(F.col("_times"), F.col("_need") - F.coalesce(before, F.lit(0)))
        rows = rows.unionByName(_matched(missing, other, [key]).select(*columns, taken.alias("_times")).where("_times > 0"))
    return fresh.unionByName(rows.withColumn("_times", F.explode(F.sequence(F.lit(1).cast("bigint"), "_times"))).drop("_times"))


def _matched(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on equal ``columns``, of which one copy stays; NULL equals NULL."""
    named = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns))
    return left.join(named, same, how).drop(*[f"_right_{c}" for c in columns])


def append_new_keys(
    new: DataFrame, existing: DataFrame, key: str, append: Callable[[DataFrame], None]
) -> None:
    """Append the rows that the target lacks, see ``new_rows``; repeating it adds nothing.

    The target is read between the smallest and largest new key only; that filter
    is pushed into its scan. ``new`` is read more than once, so pass a staged frame.
    """
    with scratch_folder(new.sparkSession, "append") as folder:
        append(new_rows(new, _around(existing, key, *new.agg(*_bounds(key)).first()), key, folder))


def _bounds(key: str) -> list[Column]:
    """Smallest and largest key, and whether one is NULL."""
    return [F.min(key), F.max(key), F.count_if(F.col(key).isNull()) > 0]


def _around(df: DataFrame, key: str, lowest: object, highest: object, nulls: bool) -> DataFrame:
    """Rows of ``df`` with a key in these bounds."""
    inside = F.lit(False) if lowest is None else F.col(key).between(lowest, highest)
    return df.where(inside | F.col(key).isNull() if nulls else inside)


def require_loaded(table: str, staged: DataFrame, loaded: DataFrame, key: str) -> None:
    """Raise unless the target has, of every key, at least the rows that were to be loaded.

    The target is read between the smallest and largest staged key only, and first both sides
    are just scanned: equal counts and equal sums of the keys' 64-bit hashes end the check.
    Else the target holds more, or less, and rows are counted per key.
    """
    kind = staged.schema[key].dataType
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64(key).cast("decimal(38,0)"))]
    *bounds, rows, hashes = staged.agg(*_bounds(key), *mark).first()
    loaded = _around(loaded, key, *bounds).select(F.col(key).cast(kind).alias(key))
    if (rows, hashes) == tuple(loaded.agg(*mark).first()):
        return
    wanted = staged.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    found = loaded.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("m"))
    short = wanted.alias("w").join(found.alias("f"), F.expr("w.k <=> f.k"), "left")
    missing = short.agg(F.coalesce(F.sum(F.greatest(F.col("n") - F.coalesce("m", F.lit(0)), F.lit(0))), F.lit(0))).first()[0]
    if missing:
        raise CheckFailed(f"table {table} lacks {missing} rows after the load")
