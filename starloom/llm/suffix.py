"""Repeated passages: bytes covered by a string of ``length`` bytes that starts anywhere else too.

One index over a whole corpus would be one task, so the corpus is first cut to what can match:

1. Every window of ``length`` bytes holds an anchor, the ``anchor`` bytes of smallest hash in it.
   Equal windows hold equal anchors at the same place, so only anchors that occur twice matter.
2. An anchor's context is all bytes that a window around it can reach. Contexts are told
   apart by their content, copies of one counted: a context that occurs twice is repeated
   as a whole, and a group of copies costs one row from here on.
3. The different contexts of one anchor meet in a task, which joins many small groups and builds
   a run-length index: the Burrows-Wheeler transform's runs with the suffix positions at
   both ends of each. There the longest match with the neighbouring suffix is measured;
   everywhere else it is one less than at the byte before (after the predecessor's run
   heads, the successor's run tails), so matching statistics stream from the samples.
4. An anchor with very many different contexts would be one large group. Its contexts are
   halved instead: by how many bytes a window has before the anchor, in dyadic ranges.
   A range is dropped unless what all its windows share occurs twice, marked unless what
   they cover does not, and else halved, down to single windows. Each step is an aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import ROW_KEY, row_key, sparing, staged, with_files
from starloom.llm.encoding import byte_slices
from starloom.llm.simhash import text_groups, xxh64

ANCHOR = 48
#: Contexts of one anchor that one index takes; beyond, the group is halved (step 4).
INDEXED = 256
#: Bytes that one index takes, in some 170 times their memory, bytes of text that are searched for anchors together
#: (what a core's cache holds), and bytes of text that are cut together.
INDEX_BYTES, GROUP_BYTES, CUT_BYTES = 1 << 18, 1 << 19, 1 << 20


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the 256 bytes, and powers of an odd number and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    fill = lambda x: np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(x))]), dtype=np.uint64)
    values = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return values, fill(base), fill(pow(base, -1, 1 << 64))


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``data`` and hashes of the anchors of all windows of the texts within ``bounds``."""
    n = len(data)
    whole = np.diff(bounds) >= length
    if not whole.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    values, power, inverse = _powers(max(GROUP_BYTES * 2, 1 << (n + 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(values[data] * power[:n], dtype=np.uint64)])
        h = (sums[k:] - sums[:-k]) * inverse[: n - k + 1]
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    # The smallest of each window: the upper half of the hash, then the first place.
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    width, step = length - k + 1, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, bounds[:-1][whole], 1)
    np.add.at(change, bounds[1:][whole] - length + 1, -1)
    inside = np.cumsum(change[: len(least)]) > 0
    at = np.unique(least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at, h[at]


def _anchored(docs: DataFrame, length: int, k: int, contexts: bool = True) -> DataFrame:
    """One row per anchor of ``docs`` (key, text): h, c (its context's content), key, pos, left, size; or h alone."""
    reach = length - k
    key_type = pa.struct([("file", pa.int64()), ("row", pa.int64())])
    kinds = {"h": pa.int64(), "c": pa.int64(), "key": key_type, "pos": pa.int32(), "left": pa.int32(), "size": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key")
            for i, _, data, bounds in text_groups(batch.column("text"), GROUP_BYTES):
                last = -1
                for s in range(0, max(1, len(data)), GROUP_BYTES) if len(bounds) == 2 else [0]:
                    part = data[s : s + GROUP_BYTES + length - 1] if len(bounds) == 2 else data
                    at, h = anchors(part, np.minimum(bounds - s, len(part)) if s == 0 else np.array([0, len(part)]), length, k)
                    # Windows of two parts can have one anchor, the last of the first part.
                    at, h = at[at + s > last] + s, h[at + s > last]
                    if not len(at):
                        continue
                    last = int(at[-1])
                    if not contexts:
                        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])
                        continue
                    doc = np.searchsorted(bounds, at, "right") - 1
                    left = np.minimum(at - bounds[doc], reach)
                    size = left + k + np.minimum(bounds[doc + 1] - at - k, reach)
                    low = max(0, s - reach)
                    c = xxh64(data[low : s + len(part) + reach], at - left - low, size) ^ (left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                    columns = {"h": h.view(np.int64), "c": c.view(np.int64), "pos": at - bounds[doc], "left": left, "size": size}
                    arrays = {"key": keys.take(pa.array(i + doc))} | {n: pa.array(x, kinds[n]) for n, x in columns.items()}
                    yield pa.RecordBatch.from_arrays([arrays[n] for n in kinds], list(kinds))

    if not contexts:
        return docs.select("key", "text").mapInArrow(sparing(run), "h long")
    return docs.select("key", "text").mapInArrow(sparing(run), f"h long, c long, key {ROW_KEY}, pos int, left int, size int")


def suffix_order(key: np.ndarray, known: int = 1, room: np.ndarray | None = None, piece: np.ndarray | None = None) -> np.ndarray:
    """The order of all suffixes, by doubling the compared length of those that are still equal.

    ``key`` orders suffixes by their first ``known`` symbols. A suffix has ``room`` symbols (by default
    all to the array's end); of those that end equal the one of the smaller ``piece`` comes first.
    """
    n = len(key)
    place = np.arange(n)
    room = n - place if room is None else room
    piece = np.zeros(n, np.int64) if piece is None else piece
    many = int(piece.max(initial=0)) + 1
    order = np.argsort(key)
    rank, tied = np.zeros(n, np.int64), place
    ordered = key[order]
    while len(tied):
        fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        own = order[tied]
        # A rank is the place of the first of those that are still equal, so it stays when others are split.
        rank[own] = np.maximum.accumulate(np.where(fresh, tied, 0))
        left = ~(fresh & np.concatenate([fresh[1:], [True]]))
        tied, own = tied[left], own[left]
        after = np.where(room[own] > known, rank[np.minimum(own + known, n - 1)] + many, piece[own])
        ordered = (rank[own] << 32) | after
        by = np.argsort(ordered)
        order[tied], ordered = own[by], ordered[by]
        known *= 2
    return order


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at ``a`` and ``b``, at most ``most``."""
    padded = np.concatenate([text, np.zeros(int(most.max(initial=0)) + 8, np.uint16)])
    words = np.ndarray((len(padded) - 3,), "<u8", padded, strides=(2,))
    out, live = np.zeros(len(a), np.int64), np.arange(len(a))
    while len(live):
        x = words[a[live] + out[live]] ^ words[b[live] + out[live]]
        same = x == 0
        low = x & (~x + np.uint64(1))
        out[live] += np.where(same, 4, np.bitwise_count(low - np.uint64(1)) // 16)
        live = live[same & (out[live] < most[live])]
    return np.minimum(out, most)


def matching_statistics(pieces: Sequence[bytes], slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each byte of the joined ``pieces`` the longest match that starts there, ends within its
    piece and starts in another piece too; each piece's first place; and the number of runs.

    Byte i of a piece is a symbol of its own for each value and each ``slots[piece] + i``, so
    that only bytes of equal slots match. The byte after each piece is unlike all others.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    firsts = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.zeros(firsts[-1], np.uint16)
    solid = np.ones(len(text), bool)
    solid[firsts[1:] - 1] = False
    text[solid] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint16) + 1
    place = np.arange(len(text))
    room = np.repeat(firsts[1:] - 1, sizes + 1) - place
    slot = np.repeat(slots - firsts[:-1], sizes + 1) + place
    symbols = (slot.astype(np.uint64) << np.uint64(9)) | text
    symbols[~solid] = (np.uint64(1) << np.uint64(60)) + np.arange(len(pieces), dtype=np.uint64)
    # Several symbols a key: those after the first are at the slots that follow.
    slot_bits = int(slot.max(initial=0)).bit_length()
    known = max(1, (63 - slot_bits) // 9)
    key, padded = slot.copy(), np.concatenate([text, np.zeros(known, np.uint16)])
    for k in range(known):
        key = (key << 9) | np.where(k < room, padded[k : k + len(text)], 0)
    order = suffix_order(key, known, room + 1, np.repeat(np.arange(len(pieces)), sizes + 1))
    bwt = symbols[order - 1]  # the symbol before each suffix; before the first, the last
    cut = bwt[1:] != bwt[:-1]
    best = np.zeros(len(text), np.int64)
    for heads in (True, False):
        near = np.full(len(text), -1, np.int64)
        sampled = np.zeros(len(text), bool)
        if heads:
            near[order[1:]] = order[:-1]
            sampled[order[1:][cut]] = True
        else:
            near[order[:-1]] = order[1:]
            sampled[order[:-1][cut]] = True
        sampled[[0, order[0], order[-1]]] = True
        samples = np.flatnonzero(sampled)
        other = near[samples]
        most = np.where((other >= 0) & (slot[samples] == slot[other]), room[samples], 0)
        found = _common(text, samples, np.maximum(other, 0), most)
        last = np.cumsum(sampled) - 1
        best = np.maximum(best, found[last] - (place - samples[last]))
    return best, firsts, int(cut.sum()) + 1


def repeated_spans(pieces: Sequence[bytes], slots: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each piece the spans covered by windows that another piece holds in the same slots; spans
    of separate runs of windows may overlap."""
    if not pieces:
        return []
    best, firsts, _ = matching_statistics(pieces, slots)
    hit = np.concatenate([[False], best >= length, [False]])
    begin, end = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:])
    piece = np.searchsorted(firsts, begin, "right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for p, s, e in zip(piece.tolist(), (begin - firsts[piece]).tolist(), (end - firsts[piece]).tolist(), strict=True):
        out[p].append((s, e - 1 + length))
    return out


SPANS = "array<struct<s:int,e:int>>"
MARKS = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))])


def _indexed(contexts: DataFrame, length: int, k: int) -> DataFrame:
    """Spans of ``contexts`` (h, c, n, left, body) by run-length indexes over whole groups of h.

    Contexts of one text overlap; slots make only places at the same distance from equal
    anchors match, which are never one and the same place of the text.
    """

    def marks(rows: list[tuple]) -> pa.RecordBatch:
        h = np.array([r[0] for r in rows])
        group = np.concatenate([[0], np.cumsum(h[1:] != h[:-1])])
        slots = group * 2 * length + (length - k) - np.array([r[3] for r in rows])
        spans = repeated_spans([r[4] for r in rows], slots, length)
        kept = [(r[0], r[1], [{"s": s, "e": e} for s, e in x]) for r, x in zip(rows, spans, strict=True) if x and r[2] == 1]
        columns = list(zip(*kept, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, MARKS, strict=True)], schema=MARKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("h", "c", "n", "left", "body")), strict=True):
                if held >= INDEX_BYTES and row[0] != rows[-1][0]:
                    yield marks(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[4])
        if rows:
            yield marks(rows)

    grouped = contexts.select("h", "c", "n", "left", "body").repartition("h").sortWithinPartitions("h")
    return grouped.mapInArrow(sparing(run), f"h long, c long, spans {SPANS}")


def _halved(contexts: DataFrame, length: int, k: int) -> DataFrame | None:
    """Spans of ``contexts`` (h, c, body, left, size) by halving the ranges of windows."""
    reach = length - k
    width = 1 << reach.bit_length()
    nodes = contexts.select("h", "c", "body", "left", (F.col("size") - F.col("left") - k).alias("right"), F.lit(0).alias("lo"))
    found: list[DataFrame] = []
    while width > 1:
        width //= 2
        nodes = nodes.withColumn("lo", F.explode(F.expr(f"filter(array(lo, lo + {width}), x -> x <= left AND x <= {reach} AND right >= {reach} - x - {width - 1})")))
        nodes = nodes.withColumns(
            {
                "least": F.expr(f"greatest(0, {reach} - lo - {width - 1})"),
                "a": F.expr(f"least(lo + {width - 1}, left, {reach})"),
                "b": F.expr(f"least({reach} - lo, right)"),
            }
        )
        nodes = staged(
            nodes.withColumns(
                {
                    "inner": F.expr(f"md5(substring(body, left - lo + 1, lo + {k} + least))"),
                    "hull": F.expr(f"md5(substring(body, left - a + 1, a + {k} + b))"),
                }
            ),
            "ranges",
        )
        # Staged, so that the joins have a plain shuffle on both sides, which AQE can split at a hot range.
        twice = lambda by, nodes=nodes: staged(nodes.groupBy(*by).agg(F.count("*").alias("times")).where("times > 1").drop("times"), "twice")
        shared = ["h", "lo", "inner"]
        whole = ["h", "lo", "a", "b", "hull"]
        alive = nodes.join(twice(shared), shared, "left_semi")
        hulls = twice(whole).withColumn("whole", F.lit(True))
        alive = staged(alive.join(hulls, whole, "left"), "ranges")
        found.append(
            alive.where("whole").select(
                "h", "c", F.expr(f"array(struct(left - a AS s, left - greatest(lo, {reach} - right) + {length} AS e))").alias("spans")
            )
        )
        nodes = alive.where("whole IS NULL").select("h", "c", "body", "left", "right", "lo")
        if nodes.isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def repeated_passages(docs: DataFrame, length: int = 200, anchor: int = ANCHOR) -> DataFrame:
    """(key, spans) of the rows of ``docs`` (key, text) that hold repeated windows; spans may overlap."""
    if not 8 <= anchor < length:
        raise ValueError("the anchor must be 8 bytes or more and shorter than the passages")
    rows = _anchored(docs, length, anchor)
    # Staged, so that the join has a plain shuffle on both sides, which AQE can split at a hot anchor.
    twice = staged(_anchored(docs, length, anchor, contexts=False).groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "twice")
    seen = staged(rows.join(twice, "h", "left_semi"), "anchors")
    contents = staged(
        seen.groupBy("h", "c").agg(
            F.count("*").alias("n"), F.min(F.struct("key", "pos")).alias("one"), F.min("left").alias("left"), F.min("size").alias("size")
        ),
        "contexts",
    )
    groups = staged(contents.groupBy("h").agg(F.count("*").alias("different")).where("different > 1"), "groups")
    wanted = contents.join(groups, "h")
    per_doc = wanted.groupBy(F.col("one.key").alias("key")).agg(
        F.collect_list(F.struct("h", "c", "n", F.col("one.pos").alias("pos"), "left", "size", "different")).alias("wanted")
    )
    fetched = docs.select("key", F.col("text").cast("binary").alias("bytes")).join(per_doc, "key")
    bodies = staged(
        fetched.select(
            F.explode(F.expr("transform(wanted, x -> struct(x.h, x.c, x.n, x.left, x.size, x.different, substring(bytes, x.pos - x.left + 1, x.size) AS body))")).alias("x")
        ).select("x.*"),
        "bodies",
    )
    marks = [
        contents.where("n > 1").select("h", "c", F.expr("array(struct(0 AS s, size AS e))").alias("spans")),
        _indexed(bodies.where(F.col("different") <= INDEXED), length, anchor),
    ]
    large = bodies.where(F.col("different") > INDEXED)
    if not large.isEmpty():
        marks.append(_halved(large, length, anchor).join(contents.where("n = 1").select("h", "c"), ["h", "c"], "left_semi"))
    every = staged(reduce(DataFrame.unionByName, marks), "marks")
    placed = seen.join(every, ["h", "c"]).select(
        "key", F.explode(F.expr("transform(spans, x -> struct(pos - left + x.s AS s, pos - left + x.e AS e))")).alias("x")
    )
    return placed.groupBy("key").agg(F.collect_set("x").alias("spans"))


def merged(spans: list[dict] | None, data: bytes, characters: bool) -> list[tuple[int, int]]:
    """Maximal runs of ``spans``, in order. With ``characters`` cut back to whole UTF-8 characters."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or []):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    if characters:
        for run in out:
            while run[0] < run[1] and data[run[0]] & 0xC0 == 0x80:
                run[0] += 1
            while run[1] > run[0] and run[1] < len(data) and data[run[1]] & 0xC0 == 0x80:
                run[1] -= 1
    return [(s, e) for s, e in out if s < e]


def suffix_dedup(
    docs: DataFrame, length: int = 200, carry: Sequence[str] = ("doc_id",), anchor: int = ANCHOR, characters: bool = False
) -> DataFrame:
    """One row per row of ``docs``: its ``carry`` columns, n_bytes, removed (array of byte spans), kept (binary).

    Removed is every byte covered by a string of ``length`` bytes that also starts at another
    place of the corpus, in the same text or another; strings are judged on the input and
    never cross texts. With ``characters`` a removed run gives up bytes of characters that it
    covers in part, so that ``kept`` stays valid UTF-8.

    See ``with_files`` for what ``docs`` may be: rows are told apart by file and row, not by
    doc_id, so null and repeated ids are separate texts. ``carry`` may name any of its columns
    but n_bytes, removed and kept, which raise. Null text is empty. Texts shorter than
    ``length`` stay whole. Two equal rows remove each other. Long texts are searched for
    anchors in parts of bounded size. Empty table: no rows.
    """
    if clash := {"n_bytes", "removed", "kept"} & set(carry):
        raise ValueError(f"columns to carry clash with the result: {sorted(clash)}")
    keyed = with_files(docs, *carry, "text").select(
        *carry, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"), row_key().alias("__key")
    )
    spans = repeated_passages(keyed.select(F.col("__key").alias("key"), F.col("__text").alias("text")), length, anchor)
    joined = keyed.join(spans.select(F.col("key").alias("__key"), F.col("spans").alias("__spans")), "__key", "left").drop("__key")
    schema = T.StructType(
        [docs.schema[c] for c in carry]
        + [
            T.StructField("n_bytes", T.LongType()),
            T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(i, j - i) for b in batches for i, j in byte_slices(b.column("__text"), CUT_BYTES)):
            sizes, removed, kept = [], [], []
            for text, spans in zip(part.column("__text"), part.column("__spans").to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                runs = merged(spans, data, characters)
                edges = [0, *(x for r in runs for x in r), len(data)]
                sizes.append(len(data))
                removed.append([{"start": s, "end": e} for s, e in runs])
                kept.append(b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
            columns = [part.column(c) for c in carry]
            columns += [pa.array(sizes, pa.int64()), pa.array(removed, span_type), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "n_bytes", "removed", "kept"])

    return joined.mapInArrow(sparing(run), schema)
