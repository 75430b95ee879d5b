"""Inner lookup joins, declared or probed.

Builders take the join as an argument. ``declared_join`` leaves everything to Catalyst
and AQE. ``ProbedJoin`` measures the two frames that are really joined: it broadcasts
a lookup only after measuring it, and takes keys that would fill a reducer on their own
out of the shuffle. Both return the same rows, at every size by the same rules.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (left, right, key, name of the lookup) -> joined
Join = Callable[[DataFrame, DataFrame, str, str], DataFrame]

BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
# A key is hot if it has this many times the rows of an average reducer.
HOT_REDUCERS = 2.0
# Hash buckets in which rows are counted before keys are, for each shuffle partition.
BUCKETS_A_REDUCER = 64


def declared_join(left: DataFrame, right: DataFrame, key: str, lookup: str = "") -> DataFrame:
    """Plain inner equi-join on a column of the same name in both frames."""
    return left.join(right, key, "inner")


class ProbedJoin:
    """Inner equi-join planned from measurements of its two sides.

    A measured-small ``right`` is broadcast, so ``left`` is not shuffled at all. Otherwise
    the hot keys of ``left`` are looked up: their rows meet a broadcast of their partners
    where those are measured small, and are spread by salts where not.

    ``sizes`` gives proven sizes of lookups by name, see ``lookup_sizes``; those are not
    measured again.
    """

    def __init__(
        self,
        broadcast_rows: int | None = None,
        broadcast_bytes: int | None = None,
        hot_reducers: float = HOT_REDUCERS,
        sizes: Mapping[str, Size] | None = None,
    ) -> None:
        self._rows, self._bytes, self._hot, self._sizes = broadcast_rows, broadcast_bytes, hot_reducers, sizes or {}

    def _is_small(self, df: DataFrame, lookup: str = "") -> bool:
        if lookup in self._sizes:
            return self._sizes[lookup].fits(self._rows, self._bytes)
        return is_small(df, self._rows, self._bytes)

    def __call__(self, left: DataFrame, right: DataFrame, key: str, lookup: str = "") -> DataFrame:
        if self._is_small(right, lookup):
            return left.join(F.broadcast(right), key, "inner")
        hot = hot_keys(left, key, self._hot)
        if not hot.rows:
            return left.join(right, key, "inner")
        if self._is_small(right.join(F.broadcast(hot.frame(right, key)), key, "left_semi")):
            return split_join(left, right, key, hot)
        return salted_join(left, right, key, hot)


@dataclass(frozen=True)
class Size:
    """At most so many rows and bytes, of which the longest row has ``longest``; ``times`` of one key."""

    rows: int
    bytes: int
    longest: int
    times: int

    def fits(self, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
        """Whether a broadcast may hold it."""
        max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
        max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
        return self.rows <= max_rows and self.bytes <= max_bytes

    def looked_up(self, lookup: Size) -> Size:
        """What an inner join with ``lookup``, on its key, can have at most."""
        rows = self.rows * lookup.times
        return Size(rows, self.bytes * lookup.times + rows * lookup.longest, self.longest + lookup.longest, self.times * lookup.times)


def _row_bytes(df: DataFrame) -> str:
    """SQL for the bytes of a row: its text and 16 for each column."""
    variable = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    text = [f.name for f in df.schema if isinstance(f.dataType, variable)]
    return " + ".join([f"{16 * len(df.columns)}L", *(f"coalesce(octet_length(CAST(`{c}` AS STRING)), 0L)" for c in text)])


def lookup_sizes(lookups: Mapping[str, tuple[DataFrame, str]]) -> dict[str, Size]:
    """The sizes of several lookups (frame, key), from one scan of each, all in one job.

    A second job counts rows per key, of those only that are small enough to be broadcast;
    no key can have more rows than its table, which is what is said of the others.
    """
    if not lookups:
        return {}
    parts = [
        df.selectExpr(f"'{name}' AS name", "count(*) AS rows", f"coalesce(sum({_row_bytes(df)}), 0L) AS bytes", f"coalesce(max({_row_bytes(df)}), 0L) AS longest")
        for name, (df, _) in lookups.items()
    ]
    sizes = {r["name"]: Size(r["rows"], r["bytes"], r["longest"], max(1, r["rows"])) for r in reduce(DataFrame.unionAll, parts).collect()}
    small = [
        df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n")).selectExpr(f"'{name}' AS name", "n").groupBy("name").agg(F.max("n").alias("times"))
        for name, (df, key) in lookups.items()
        if sizes[name].fits() and sizes[name].rows > 1
    ]
    for r in reduce(DataFrame.unionAll, small).collect() if small else []:
        own = sizes[r["name"]]
        sizes[r["name"]] = Size(own.rows, own.bytes, own.longest, r["times"])
    return sizes


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True if the whole frame was counted and measured to fit a broadcast."""
    rows, size = df.selectExpr("count(*)", f"coalesce(sum({_row_bytes(df)}), 0L)").first()
    return Size(rows, size, 0, rows).fits(max_rows, max_bytes)


@dataclass(frozen=True)
class HotKeys:
    """The rows of each hot key, and of an average reducer."""

    rows: Mapping[object, int] = field(default_factory=dict)
    reducer: float = 1.0

    def fan_out(self, key: object) -> int:
        """Over how many salts a key is spread: four for each reducer that it would fill."""
        return max(2, round(4 * self.rows[key] / self.reducer))

    def frame(self, df: DataFrame, key: str) -> DataFrame:
        """(key, _salts) of the hot keys, typed as in ``df``; at most half as many as reducers."""
        schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("_salts", T.IntegerType())])
        return df.sparkSession.createDataFrame([(k, self.fan_out(k)) for k in self.rows], schema)


def hot_keys(df: DataFrame, key: str, hot_reducers: float = HOT_REDUCERS) -> HotKeys:
    """Keys of ``df`` with the rows of ``hot_reducers`` average reducers or more.

    All rows are counted, first per bucket of the keys' hashes, so that few counts are shuffled
    however many keys there are. A bucket has no fewer rows than any key in it, so only keys of
    buckets that are that large are then counted one by one. No more than the number of shuffle
    partitions over ``hot_reducers`` buckets can be, so looking at that many of the largest
    leaves none out.
    """
    partitions = _shuffle_partitions(df)
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    bucket, count = F.pmod(F.xxhash64("k"), F.lit(BUCKETS_A_REDUCER * partitions)), F.count(F.lit(1)).alias("n")
    seen = Observation()
    largest = (
        keys.groupBy(bucket.alias("bucket"))
        .agg(count)
        .observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        .orderBy(F.desc("n"))
        .limit(max(1, int(partitions / hot_reducers)))
        .collect()
    )
    reducer = seen.get["rows"] / partitions
    least = max(2, hot_reducers * reducer)
    large = [r["bucket"] for r in largest if r["n"] >= least]
    hot = keys.where(bucket.isin(large)).groupBy("k").agg(count).where(F.col("n") >= least).collect() if large else []
    return HotKeys({r["k"]: r["n"] for r in hot}, max(reducer, 1.0))


def split_join(left: DataFrame, right: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Inner equi-join that keeps hot rows of ``left`` where they are.

    They meet a broadcast of the few matching rows of ``right``, which the caller has
    measured; all other keys are joined as usual. Both sides are scanned twice, but the
    hot rows are neither shuffled nor sorted.
    """
    keys = F.broadcast(hot.frame(right, key).select(key))
    cold_rows = left.join(keys, key, "left_anti").join(right.join(keys, key, "left_anti"), key, "inner")
    hot_rows = left.join(F.broadcast(right.join(keys, key, "left_semi")), key, "inner")
    return cold_rows.unionByName(hot_rows)


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Inner equi-join that spreads the rows of each hot key over several reducers.

    For hot keys with too many matching rows to broadcast. Hot rows of ``left`` get a salt
    from a hash of the whole row, so a task that is run again after an executor loss
    gives the same salts. The matching rows of ``right`` are repeated once per salt of their
    own key. All other rows have salt 0 and are neither copied nor moved differently.
    """
    salts = F.broadcast(hot.frame(right, key))
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    spread = F.coalesce(F.col("_salts"), F.lit(1))
    salted_left = left.join(salts, key, "left").withColumn("_salt", F.pmod(row_hash, spread).cast("int")).select(*left.columns, "_salt")
    every = F.explode(F.sequence(F.lit(0), spread - 1))
    salted_right = right.join(salts, key, "left").withColumn("_salt", every).select(*right.columns, "_salt")
    return salted_left.join(salted_right, [key, "_salt"], "inner").drop("_salt")


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dropped_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row ``(dropped bigint)``: how many rows an inner join on ``key`` loses.

    ``left`` is counted per key first, so a hot key reaches the join as one row.
    A NULL key never matches and counts as dropped.
    """
    per_key = left.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    present = right.select(F.col(key).alias("k")).distinct()
    missing = per_key.join(present, "k", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("dropped"))
