"""What the operators share: staging in the shared folder, row keys, connected components, memory given back."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.session import remove_folder, shared_folder

#: The folders made since ``tidy`` began, if it did.
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that all executors share."""
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that its lineage ends there."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def tidy(spark: SparkSession, work: Callable[[], DataFrame], name: str) -> DataFrame:
    """The result of ``work`` staged; of the folders made for it nothing else stays, also after an error."""
    made: list[str] = []
    before = _MADE.set(made)
    try:
        result = work()
        _MADE.reset(before)
        return staged(result, name)
    finally:
        if _MADE.get() is made:
            _MADE.reset(before)
        for path in made:
            remove_folder(spark, path)


def remove_table(df: DataFrame) -> None:
    """Delete the folder that a frame read back by ``staged`` stands for."""
    if files := df.inputFiles():
        remove_folder(df.sparkSession, files[0].rsplit("/", 1)[0])


#: The columns of a row key.
ROW_KEY = "struct<file:long,row:long>"


def row_key() -> Column:
    """A hash of a row's file and its number in it: the same in every scan, however Spark splits the files."""
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def with_files(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` as a frame in which ``row_key`` can be taken.

    A frame over Parquet files, projected or filtered, is left as it is; it must not hold a row
    of a file twice, as an explode would make it. Any other frame is staged first.
    """
    rows = docs.select(*dict.fromkeys(columns))
    try:
        rows.select(row_key())
    except AnalysisException:
        return staged(rows, "rows")
    return rows


def give_back() -> None:
    """Return memory that is free, but kept by Arrow and the C library, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def sparing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for mapInArrow, that gives memory back at its end.

    A worker outlives its task and counts towards its executor's memory, also while another
    stage runs whose own memory is elsewhere.
    """

    def spared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return spared


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: each is one aggregate with a map-side
    minimum and one join. Both sides of a join are staged, so that it has a plain shuffle on
    each, which AQE can split at a hub. Rounds grow with the logarithm of the longest
    chain, and stop when the links no longer change. Nulls and self-links are ignored.
    """
    edges = staged(
        links.where("a != b").select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(),
        "links",
    )
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == before or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select("v", "v").distinct()
            )
        before = tuple(mark)
        both = edges.select("u", "v").union(edges.select("v", "u"))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct(), "links")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")
        )
        edges = staged(small.where("u != v").distinct(), "links")
