"""The corpus pipeline: toxicity, line dedup, near-dedup, suffix-array dedup, packing.

Each stage works on all that the one before kept. The first four return the columns of
``documents``; n_chars follows the text. Packing returns pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import remove_table, table, tidy
from starloom.llm.lines import line_dedup
from starloom.llm.packing import packed
from starloom.llm.simhash import simhash_dedup
from starloom.llm.suffix import suffix_dedup
from starloom.llm.toxicity import toxicity_scorer

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents scored at least this toxic go.
TOXIC_FROM = 0.7

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below ``TOXIC_FROM``, as they are; learned from ``labels``."""
    score = toxicity_scorer(docs, table(spark, sf_dir, "labels"))
    return score(docs.select(*COLUMNS), keep_text=True).where(F.col("score") < TOXIC_FROM).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of later copies of three-line windows."""
    kept = line_dedup(docs, width=3, carry=("doc_id", "lang", "source"))
    return kept.withColumn("text", F.col("kept")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component (4-word shingles, 4 bits), the one of smallest doc_id; judged by row."""
    return simhash_dedup(docs, carry=COLUMNS, words=4, bits=4)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of passages of 200 bytes and more that occur twice; whole characters only."""
    kept = suffix_dedup(docs, length=200, carry=("doc_id", "lang", "source"), characters=True)
    return kept.withColumn("text", F.col("kept").cast("string")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 ids, with a digest of each."""
    pieces = packed(docs, public_tokenizers.path("word_bpe_49k.json"), "dropped", end_id=1, size=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeated_passages),
    ("packing", pack),
]

#: Neither the scores nor the packing can be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written as Parquet and read again.

    What a stage put into the shared folder goes once its result is written, and that result
    once the next one is.
    """
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        before, docs = docs, tidy(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        if number:
            remove_table(before)
    return docs
