"""Line dedup over overlapping windows of consecutive lines."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import row_key, sparing, staged, with_files
from starloom.llm.encoding import byte_slices

#: Bytes of text that are cut together.
CUT_BYTES = 1 << 20


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """One row per window of ``docs`` (id, key, text): its 128-bit hash, id, key and first line's number."""
    lines = F.split("text", "\n", -1)
    shifted = [lines, *(F.slice(lines, k + 1, F.greatest(F.size(lines) - k, F.lit(0))) for k in range(1, width))]
    names = [f"l{k}" for k in range(width)]
    zipped = F.arrays_zip(*(a.alias(n) for a, n in zip(shifted, names, strict=True)))
    long_enough = docs.where(F.instr("text", "\n") > 0) if width > 1 else docs
    rows = long_enough.select("id", "key", F.posexplode(zipped).alias("pos", "w"))
    parts = [F.col("w")[n] for n in names]
    blank: Column = F.trim(F.concat(*parts)) == ""
    return rows.where(parts[-1].isNotNull() & ~blank).select(
        F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *reversed(parts)).alias("h2"), "id", "key", "pos"
    )


def line_dedup(docs: DataFrame, width: int = 3, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per row of ``docs``: its ``carry`` columns, n_lines, removed (numbers of lines from 0), kept (text).

    Lines end at line feeds and are compared exactly. Every run of ``width`` lines is a window, told
    apart by two 64-bit hashes; of each window the first by (doc_id, place) stays, and every
    line that a later one covers is removed, also where windows overlap, so a line repeated
    over and over shrinks to its first. Windows of blank lines only do not count.

    ``docs`` needs doc_id and text; see ``with_files`` for what it may be. Rows of null or
    repeated doc_id are told apart by file and row. ``carry`` may name any of its columns but
    n_lines, removed and kept, which raise. Null text: no lines, kept is null. Texts of fewer
    lines than ``width`` stay whole. A text of any length is split in one piece, in a few
    times its own memory. Empty table: no rows.
    """
    if clash := {"n_lines", "removed", "kept"} & set(carry):
        raise ValueError(f"columns to carry clash with the result: {sorted(clash)}")
    keyed = with_files(docs, *carry, "doc_id", "text").select(
        *carry, F.col("text").cast("string").alias("__text"), F.col("doc_id").cast("long").alias("__id"), row_key().alias("__key")
    )
    texts = keyed.select(F.col("__id").alias("id"), F.col("__key").alias("key"), F.col("__text").alias("text"))
    windows = staged(_windows(texts, width), "windows")
    firsts = (
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("times"), F.min(F.struct("id", "key", "pos")).alias("first"))
        .where("times > 1")
        .select("h1", "h2", F.col("first.key").alias("first_key"), F.col("first.pos").alias("first_pos"))
    )
    # Staged, so that the join has a plain shuffle on both sides, which AQE can split at a hot window.
    firsts = staged(firsts, "firsts")
    later = windows.join(firsts, ["h1", "h2"]).where("key != first_key OR pos != first_pos")
    covered = later.groupBy(F.col("key").alias("__key")).agg(F.collect_set("pos").alias("__starts"))
    joined = keyed.drop("__id").join(covered, "__key", "left").drop("__key")
    schema = T.StructType(
        [docs.schema[c] for c in carry]
        + [T.StructField("n_lines", T.LongType()), T.StructField("removed", T.ArrayType(T.IntegerType())), T.StructField("kept", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(i, j - i) for b in batches for i, j in byte_slices(b.column("__text"), CUT_BYTES)):
            counts, removed, kept = [], [], []
            for text, starts in zip(part.column("__text"), part.column("__starts"), strict=True):
                lines = text.as_py().split("\n") if text.is_valid else []
                gone = np.zeros(len(lines), bool)
                if starts.is_valid:
                    at = starts.values.to_numpy()
                    for k in range(width):
                        gone[at + k] = True
                counts.append(len(lines))
                removed.append(np.flatnonzero(gone).astype(np.int32))
                if not text.is_valid or not gone.any():
                    kept.append(text.as_py())
                else:
                    kept.append("\n".join(line for line, g in zip(lines, gone.tolist(), strict=True) if not g))
            columns = [*(part.column(c) for c in carry), pa.array(counts, pa.int64()), pa.array(removed, pa.list_(pa.int32())), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*carry, "n_lines", "removed", "kept"])

    return joined.mapInArrow(sparing(run), schema)
