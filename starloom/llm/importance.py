"""Importance resampling towards a target: hashed n-gram weights, Gumbel top-k without replacement.

Words are found a batch at a time: the batch's texts are joined with a separator, one expression
passes over the whole, and the documents' offsets tell which n-grams would reach over a
separator; those are masked before the buckets are counted. An n-gram's crc32 is put
together from its words' (crc32 is linear), so no n-gram is ever built as text.

The order of all documents is found by ranges of score, without one task that sees them all.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import staged
from starloom.llm.encoding import byte_slices

#: Words in UTF-8 with ASCII capitals lowered, and what stands between two texts.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SEPARATOR = b"\x00"
#: Bytes of text joined at once, and the longest word handled by tables.
GROUP_BYTES, LONG_WORD = 2 << 20, 64


@lru_cache(maxsize=1)
def _crc_table() -> np.ndarray:
    """crc32 of one more byte: the reflected table of polynomial 0xEDB88320."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """[n, k, b]: what byte k = b of a crc32 becomes when n bytes follow, the bytes' own crc32 left out."""
    table = _crc_table()
    out = np.zeros((LONG_WORD + 1, 4, 256), dtype=np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(LONG_WORD):
        out[n + 1] = table[out[n] & np.uint32(255)] ^ (out[n] >> np.uint32(8))
    return out


def word_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of every word."""
    table, size = _crc_table(), ends - starts
    state = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    live = np.flatnonzero(size <= LONG_WORD)
    for j in range(LONG_WORD):
        live = live[size[live] > j]
        if not len(live):
            break
        own = state[live]
        state[live] = table[(own ^ data[starts[live] + j]) & np.uint32(255)] ^ (own >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > LONG_WORD):
        state[i] = zlib.crc32(data[starts[i] : ends[i]])
    return state


def extended(before: np.ndarray, word: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of texts with crc32 ``before``, a space and the words of crc32 ``word``, joined."""
    before = _spaced(before)
    size, shifts = np.minimum(ends - starts, LONG_WORD), _shifts()
    out = word.copy()
    for k in range(4):
        out ^= shifts[size, k, (before >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : ends[i]], int(before[i]))
    return out


def _spaced(crc: np.ndarray) -> np.ndarray:
    """crc32 with a space behind."""
    state = crc ^ np.uint32(0xFFFFFFFF)
    return _crc_table()[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8)) ^ np.uint32(0xFFFFFFFF)


def features(texts: Sequence[bytes], longest: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for each length of n-grams their texts' numbers and buckets.

    ``texts`` are joined by ``SEPARATOR``; an n-gram counts if its first and last word are of one text.
    """
    joined = SEPARATOR.join(texts).lower()
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    edges = np.fromiter((x for m in WORD.finditer(joined) for x in m.span()), np.int64)
    starts, ends = edges[::2], edges[1::2]
    data = np.frombuffer(joined, np.uint8)
    doc = np.searchsorted(offsets, starts, "right") - 1
    crc = word = word_crcs(data, starts, ends)
    out = [(doc, (crc % np.uint32(buckets)).astype(np.int64))]
    for n in range(2, longest + 1):
        own = slice(n - 1, None)
        crc = extended(crc[:-1], word[own], data, starts[own], ends[own])
        within = doc[own] == doc[: len(crc)]
        out.append((doc[own][within], (crc[within] % np.uint32(buckets)).astype(np.int64)))
    return np.bincount(doc, minlength=len(texts)), out


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of a batch's texts of bounded size, as bytes; null is empty."""
    texts = batch.column("text").fill_null("")
    for i, j in byte_slices(texts, GROUP_BYTES):
        yield i, j, texts[i:j].cast(pa.binary()).to_pylist()


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many features of all ``texts`` (text) fall into each bucket; each task sends one sum a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, _, group in _groups(batch):
                for _, found in features(group, longest, buckets)[1]:
                    total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    parts = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(ratio of smoothed shares)) of each bucket, target over source."""
    s_all, t_all, b = float(source.sum()), float(target.sum()), len(source)
    ratio = ((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def noise(doc_id: int, seed: int) -> int:
    """floor(1000 * a Gumbel variate) that depends on ``seed`` and ``doc_id`` alone."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(docs: DataFrame, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs`` (doc_id, text)."""
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, group in _groups(batch):
                words, found = features(group, longest, len(gains))
                n, total = np.zeros(j - i, dtype=np.int64), np.zeros(j - i, dtype=np.int64)
                for doc, bucket in found:
                    n += np.bincount(doc, minlength=j - i)
                    sums = np.concatenate([[0], np.cumsum(gains[bucket])])
                    total += np.diff(sums[np.searchsorted(doc, np.arange(j - i + 1))])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                ids = batch.column("doc_id")[i:j]
                score = [None if d is None else w + noise(d, seed) for d, w in zip(ids.to_pylist(), weight.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (words, n, weight, score))], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, T.StructType([T.StructField(c, T.LongType()) for c in names]))


def ranked(rows: DataFrame, *order: object) -> DataFrame:
    """``rows`` with rank (from 1) in that order, found by ranges: each task numbers the rows of one range."""
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # Staged: which range a row is in must not change between counting and numbering.
    placed = staged(spread.withColumn("__at", F.monotonically_increasing_id()), "ranges")
    at = {"__range": F.shiftright("__at", 33), "__place": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))}
    placed = placed.withColumns(at)
    sizes = placed.groupBy("__range").agg((F.max("__place") + 1).alias("n"))  # one row a range
    before = F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__range", before.alias("__before"))
    return placed.join(F.broadcast(starts), "__range").select(*rows.columns, (F.col("__before") + F.col("__place") + 1).alias("rank"))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, longest: int = 2, buckets: int = 10_000, seed: int = 7
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``docs`` (doc_id, text): a draw that
    looks like ``target`` (text). rank is the place in the draw, null if not drawn.

    Features are all runs of 1 to ``longest`` words, hashed into ``buckets``; a bucket's gain is the
    logarithm of its smoothed share in ``target`` over that in ``docs``, and a document's weight the
    mean of its features' gains, both in thousandths and floored. score adds a Gumbel variate
    from ``seed`` and doc_id, so taking the highest draws without replacement. Drawn are ``percent`` of
    the documents with ``least_words`` words or more, ties to the smaller doc_id.

    Null text: no words, weight 0. Null doc_id: no score, never drawn and not counted. Repeated
    doc_ids: each row is a document; equal scores are ordered by n_features. A text of any length
    is one group, in some 30 times its own memory. Empty ``target``: gains from ``docs`` alone.
    Empty ``docs``: no rows.
    """
    gains = bucket_gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    rows = staged(_scored(docs, gains, longest, seed), "scored")
    may = F.coalesce((F.col("n_words") >= least_words) & F.col("score").isNotNull(), F.lit(False))
    drawn = percent * rows.where(may).count() // 100
    order = ranked(rows.where(may), F.desc("score"), F.asc("doc_id"), F.asc("n_features"))
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return order.withColumn("rank", rank).unionByName(rows.where(~may).withColumn("rank", F.lit(None).cast("long")))
