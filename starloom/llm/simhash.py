"""SimHash fingerprints of word shingles, linked by pigeonring filtering.

A text is lower-cased in A-Z, cut into words at ASCII white space, and each run of
``words`` words, joined by one space, is hashed with XXH64 (seed 42). A bit of the
fingerprint is set when more than half of the hashes set it.

Two fingerprints within ``bits`` differing bits are found without comparing all pairs.
The 64 bits are cut into ``bits + 1`` segments on a ring. By the pigeonring principle some
segment starts a chain in which the differences over the first n segments never exceed
n * bits / (bits + 1), that is n - 1. So the first segment is equal and the first two
differ in at most one bit: both together are the join key, with the one-bit variants of the
second segment on the probing side. The rest of the chain and the full Hamming distance are
tested inside the join, so only true links leave it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import components, row_key, sparing, staged, with_files

SEED = 42
#: Constants of the public XXH64 definition.
P1, P2, P3, P4, P5 = (
    np.uint64(x)
    for x in (
        11400714785074694791,
        14029467366897019727,
        1609587929392839161,
        9650029242287828579,
        2870177450012600261,
    )
)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, *range(9, 14)]] = True
#: Bytes of text handled together, in some 35 times their memory, and the shingle length from which the library hashes one by one.
GROUP_BYTES, LONG_SHINGLE = 1 << 20, 1024


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _rotl(acc + word * P2, 31) * P1


def xxh64(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many slices of one byte array at once."""
    out = np.empty(len(start), dtype=np.uint64)
    big = length >= LONG_SHINGLE
    for i in np.flatnonzero(big):
        out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + length[i]].tobytes(), seed)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    halves = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    rest = np.flatnonzero(~big)
    at, left = start[rest].astype(np.int64), length[rest].astype(np.int64)
    total = left.astype(np.uint64)
    acc = np.full(len(rest), np.uint64(seed) + P5)
    with np.errstate(over="ignore"):
        wide = np.flatnonzero(left >= 32)
        if len(wide):
            s = np.uint64(seed)
            lanes = [np.full(len(wide), x) for x in (s + P1 + P2, s + P2, s, s - P1)]
            live = np.arange(len(wide))
            while len(live):
                rows = wide[live]
                for k in range(4):
                    lanes[k][live] = _round(lanes[k][live], words[at[rows] + 8 * k])
                at[rows] += 32
                left[rows] -= 32
                live = live[left[rows] >= 32]
            h = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
            for lane in lanes:
                h = (h ^ _round(np.zeros_like(lane), lane)) * P1 + P4
            acc[wide] = h
        acc += total
        while len(r := np.flatnonzero(left >= 8)):
            acc[r] = _rotl(acc[r] ^ _round(np.uint64(0), words[at[r]]), 27) * P1 + P4
            at[r] += 8
            left[r] -= 8
        if len(r := np.flatnonzero(left >= 4)):
            acc[r] = _rotl(acc[r] ^ (halves[at[r]].astype(np.uint64) * P1), 23) * P2 + P3
            at[r] += 4
            left[r] -= 4
        while len(r := np.flatnonzero(left > 0)):
            acc[r] = _rotl(acc[r] ^ (padded[at[r]].astype(np.uint64) * P5), 11) * P1
            at[r] += 1
            left[r] -= 1
        acc = (acc ^ (acc >> np.uint64(33))) * P2
        acc = (acc ^ (acc >> np.uint64(29))) * P3
    out[rest] = acc ^ (acc >> np.uint64(32))
    return out


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts ``data[bounds[i]:bounds[i + 1]]``, and each text's first index."""
    solid = ~SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[bounds] = True
    starts = np.flatnonzero(solid & (first[:-1] | ~np.concatenate([[False], solid[:-1]])))
    ends = np.flatnonzero(solid & (first[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    size = ends - starts
    # The words again, lower-cased, each followed by one space.
    joined = np.full(int(size.sum()) + len(starts), 32, dtype=np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(starts)), size)] = LOWER[data[solid]]
    to = np.cumsum(size) + np.arange(len(size))
    fro = to - size
    word_bounds = np.searchsorted(starts, bounds)
    n_words = np.diff(word_bounds)
    n = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    edges = np.concatenate([[0], np.cumsum(n)])
    begin = np.arange(edges[-1]) - np.repeat(edges[:-1] - word_bounds[:-1], n)
    last = np.minimum(begin + words, np.repeat(word_bounds[1:], n)) - 1
    return xxh64(joined, fro[begin], to[last] - fro[begin]), edges


def fingerprints(data: np.ndarray, bounds: np.ndarray, words: int) -> np.ndarray:
    """One 64-bit fingerprint a text, zero where there is no word."""
    hashes, edges = shingle_hashes(data, bounds, words)
    n = np.diff(edges)
    out = np.zeros(len(n), dtype=np.uint64)
    sums = np.zeros(len(hashes) + 1, dtype=np.int64)
    for bit in range(64):
        np.cumsum((hashes >> np.uint64(bit)) & np.uint64(1), out=sums[1:], dtype=np.int64)
        out |= (2 * np.diff(sums[edges]) > n).astype(np.uint64) << np.uint64(bit)
    return out


def text_groups(texts: pa.Array, most: int = GROUP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``most`` bytes: first row, row after the last, bytes and bounds. Null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def fingerprinted(docs: DataFrame, words: int = 4, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``carry`` and fp (long) of every row of ``docs`` (text, more columns). One pass, no shuffle."""
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, bounds in text_groups(batch.column("text")):
                found = fingerprints(data, bounds, words).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[i:j] for c in carry), pa.array(found)], [*carry, "fp"])

    return docs.select(*carry, F.col("text").cast("string")).mapInArrow(sparing(run), schema)


def _mask(low: int, width: int) -> Column:
    value = ((1 << width) - 1) << low
    return F.lit(value - (1 << 64) if value >= 1 << 63 else value).cast("long")


def fingerprint_links(fps: DataFrame, bits: int = 4) -> DataFrame:
    """(a, b) of distinct fingerprints ``fps`` (fp) that differ in 1 to ``bits`` bits; may repeat a pair.

    Each fingerprint is indexed ``bits + 1`` times and probed once for each one-bit variant,
    whatever the data; the join splits large keys by adaptive execution.
    """
    if not 1 <= bits <= 31:
        raise ValueError("bits must lie between 1 and 31")
    m = bits + 1
    cuts = [64 * k // m for k in range(m + 1)]
    width = [cuts[k + 1] - cuts[k] for k in range(m)]

    def segment(k: int) -> Column:
        return F.shiftrightunsigned("fp", cuts[k]).bitwiseAND(F.lit((1 << width[k]) - 1).cast("long"))

    def key(k: int, flip: Column) -> Column:
        n = (k + 1) % m
        return F.shiftleft(segment(k), width[n]).bitwiseOR(segment(n).bitwiseXOR(flip))

    starts = range(m)
    none = F.lit(0).cast("long")
    index = fps.select(
        F.col("fp").alias("b"), F.explode(F.array(*[F.struct(F.lit(k).alias("k"), key(k, none).alias("key")) for k in starts])).alias("x")
    ).select("b", "x.k", "x.key")
    probes = [
        F.struct(F.lit(k).alias("k"), key(k, F.lit(flip).cast("long")).alias("key"))
        for k in starts
        for flip in [0, *(1 << i for i in range(width[(k + 1) % m]))]
    ]
    probe = fps.select(F.col("fp").alias("a"), F.explode(F.array(*probes)).alias("x")).select("a", "x.k", "x.key")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(True)
    for n in range(3, m):
        within = F.lit(False)
        for k in starts:
            masks = [_mask(cuts[(k + i) % m], width[(k + i) % m]) for i in range(n)]
            mask = masks[0]
            for other in masks[1:]:
                mask = mask.bitwiseOR(other)
            within = F.when(probe["k"] == k, F.bit_count(differing.bitwiseAND(mask)) <= n - 1).otherwise(within)
        chain = chain & within
    return probe.join(
        index,
        (probe["key"] == index["key"]) & (probe["k"] == index["k"]) & (F.col("a") < F.col("b")) & chain & (F.bit_count(differing) <= bits),
    ).select("a", "b")


def grouped(rows: DataFrame, bits: int, first: Column) -> DataFrame:
    """``rows`` (fp, more columns) with ``first``: its smallest value in the component of fp.

    Components are of links of at most ``bits`` differing bits. Equal fingerprints are one
    node, so a group of copies costs one row after the first aggregate. Pass a staged frame.
    """
    nodes = staged(rows.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    groups = staged(components(fingerprint_links(nodes.select("fp"), bits).distinct()), "components")
    named = nodes.join(groups, nodes["fp"] == groups["node"])
    # Staged, here and below, so that the joins have a plain shuffle on both sides, which AQE can split at a large group.
    smallest = staged(named.groupBy("component").agg(F.min("first").alias("linked")), "smallest")
    linked = groups.join(smallest, "component").select(F.col("node").alias("fp"), "linked")
    labels = staged(nodes.join(linked, "fp", "left").select("fp", F.coalesce("linked", "first").alias("first")), "labels")
    return rows.join(labels, "fp")


def simhash_components(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text; more columns are ignored).

    fingerprint is 16 lowercase hex digits; component_id the smallest doc_id reachable over
    links of at most ``bits`` differing bits, the row's own included.

    Null or blank text: fingerprint zero, linked like any other. Null doc_id: the row stays,
    but cannot name a component (component_id is null if all its group's ids are). Repeated
    doc_ids: one row each. A text of any length is hashed in one piece, in some 35 times its
    own memory. Empty table: empty result.
    """
    rows = staged(fingerprinted(docs.select(F.col("doc_id").cast("long"), "text"), words), "fingerprints")
    return grouped(rows, bits, F.col("doc_id")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def simhash_dedup(docs: DataFrame, carry: Sequence[str] = ("doc_id", "text"), words: int = 4, bits: int = 4) -> DataFrame:
    """The ``carry`` columns of one row of each component of ``docs`` (doc_id, text), see ``simhash_components``.

    The row of the smallest doc_id stays; of rows that repeat it, or have none while all of the
    component lack one, the first by file and row. So copies and near copies go by row, and
    unlike texts under one doc_id are judged each by its own text. Rows without words are
    one component. See ``with_files`` for what ``docs`` may be. Empty table: no rows.
    """
    keyed = with_files(docs, *carry, "doc_id", "text").withColumn("__key", row_key())
    ids = keyed.select("__key", F.col("doc_id").cast("long").alias("__id"), "text")
    rows = staged(fingerprinted(ids, words, carry=("__key", "__id")), "fingerprints")
    place = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__key").alias("key"))
    later = grouped(rows, bits, place).where("__key != first.key").select("__key")
    return keyed.join(staged(later, "later"), "__key", "left_anti").select(*carry)
