"""Token ids as plane-shuffled, compressed binary shards.

Blocks of ``BLOCK`` ids are transposed into byte or bit planes; each plane is compressed with
zstandard, an all-zero plane is stored as nothing. A shard is one file:

    magic | blocks | footer (zstandard) | footer's length (8 bytes) | magic

The footer is the chunk index (for each block: its ids and the length of each plane) and the
document table (doc_id, null flag, ids). Any block can be read by itself.

Shards hold ranges of doc_id in ascending order, so their concatenation is the corpus. A task
starts another shard when one has ``SHARD_IDS`` ids or ``SHARD_DOCS`` documents, so footers stay
small. Each is written under a name of its own attempt and then renamed, and a task that runs
again writes the same bytes; a lost executor leaves at most an unused file.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import staged
from starloom.llm.encoding import byte_slices, encoder, release

MAGIC = b"PLANES01"
BLOCK = 1 << 16
#: Ids and documents from which on a shard is closed, and shards a task can have.
SHARD_IDS, SHARD_DOCS, SHARDS_A_TASK = 1 << 28, 1 << 20, 1 << 20


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system of a folder as Spark names it."""
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def shuffled(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of one block, least significant first: 4 byte planes or 32 bit planes."""
    cells = np.ascontiguousarray(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T)
    if planes == "byte":
        return [c.tobytes() for c in cells]
    zero = bytes((len(ids) + 7) // 8)
    used = np.bitwise_or.reduce(cells, axis=1).tolist()
    return [np.packbits(c & (1 << b), bitorder="little").tobytes() if u >> b & 1 else zero for c, u in zip(cells, used, strict=True) for b in range(8)]


def unshuffled(planes: list[bytes], n: int) -> np.ndarray:
    """The inverse of ``shuffled`` for ``n`` ids; an empty plane is all zero."""
    ids = np.zeros(n, dtype=np.uint32)
    for k, plane in enumerate(planes):
        if plane and len(planes) == 4:
            ids |= np.frombuffer(plane, np.uint8).astype(np.uint32) << np.uint32(8 * k)
        elif plane:
            bits = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little", count=n)
            ids |= bits.astype(np.uint32) << np.uint32(k)
    return ids


class ShardWriter:
    """One shard, written as ids arrive; holds one block and the document table."""

    def __init__(self, sink, planes: str = "bit", block: int = BLOCK, level: int = 1) -> None:
        if planes not in ("bit", "byte"):
            raise ValueError("planes must be bit or byte")
        self.sink, self.planes, self.block = sink, planes, block
        self.zip = zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.chunks: list[list[int]] = []
        self.docs: list[int] = []
        self.nulls: list[bool] = []
        self.sizes: list[int] = []
        sink.write(MAGIC)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting)
        block, rest = ids[:n], ids[n:]
        parts = [self.zip.compress(p) if p.strip(b"\0") else b"" for p in shuffled(block, self.planes)]
        self.sink.write(b"".join(parts))
        self.chunks.append([len(block), *map(len, parts)])
        self.waiting, self.n_waiting = [rest], len(rest)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.sizes.append(len(ids))
        self.n_ids += len(ids)
        for i in range(0, len(ids), self.block):
            self.waiting.append(ids[i : i + self.block])
            self.n_waiting += len(self.waiting[-1])
            if self.n_waiting >= self.block:
                self._flush(self.block)

    def close(self) -> None:
        if self.n_waiting:
            self._flush(self.n_waiting)
        foot = io.BytesIO()
        np.savez(
            foot, chunks=np.array(self.chunks, np.int64).reshape(len(self.chunks), -1), docs=np.array(self.docs, np.int64),
            nulls=np.array(self.nulls, bool), sizes=np.array(self.sizes, np.int64),
        )
        body = self.zip.compress(foot.getvalue())
        self.sink.write(body + len(body).to_bytes(8, "little") + MAGIC)


class ShardReader:
    """A shard's footer, single blocks and documents."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.size()
        source.seek(end - 16)
        tail = source.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a shard, or one cut short")
        size = int.from_bytes(tail[:8], "little")
        source.seek(end - 16 - size)
        foot = np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(source.read(size))))
        self.chunks, self.docs, self.nulls, self.sizes = (foot[k] for k in ("chunks", "docs", "nulls", "sizes"))
        lengths = self.chunks[:, 1:].sum(1) if len(self.chunks) else np.zeros(0, np.int64)
        self.at = len(MAGIC) + np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)

    def chunk(self, k: int) -> np.ndarray:
        """The ids of block ``k``."""
        n, *lengths = map(int, self.chunks[k])
        self.source.seek(int(self.at[k]))
        body, planes, i = self.source.read(sum(lengths)), [], 0
        unzip = zstandard.ZstdDecompressor()
        for length in lengths:
            planes.append(unzip.decompress(body[i : i + length]) if length else b"")
            i += length
        return unshuffled(planes, n)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in order, holding one document and one block."""
        k, rest = 0, np.zeros(0, np.uint32)
        for doc, null, n in zip(self.docs.tolist(), self.nulls.tolist(), self.sizes.tolist(), strict=True):
            parts, need = [], n
            while need > len(rest):
                parts.append(rest)
                need -= len(rest)
                rest, k = self.chunk(k), k + 1
            parts.append(rest[:need])
            rest = rest[need:]
            yield (None if null else doc), np.concatenate(parts)


def write_tokens(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    spaces: str | None,
    end_id: int,
    planes: str = "bit",
    block: int = BLOCK,
    shard_ids: int = SHARD_IDS,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards below ``folder``; one row per shard: shard, path, n_ids, n_docs.

    Shards follow doc_id, nulls first; rows of one doc_id follow their text. A document is in one
    shard, which is closed once it has ``shard_ids`` ids or ``shard_docs`` documents. Null text is
    empty; each document ends with ``end_id``. A text of any length is encoded in one piece, in some 30 times its own
    memory, or 180 times where it has no blank to cut at. Empty table: no shard, no row.
    """
    kinds = pa.schema([("shard", pa.int64()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _system(folder)
        task, number = TaskContext.get().partitionId(), 0
        writer = sink = None
        path = temporary = ""

        def closed() -> pa.RecordBatch:
            writer.close()
            sink.close()
            system.move(temporary, path)
            row = {"shard": [task * SHARDS_A_TASK + number], "path": [path], "n_ids": [writer.n_ids], "n_docs": [len(writer.docs)]}
            return pa.RecordBatch.from_pydict(row, kinds)

        for batch in batches:
            for i, j in byte_slices(batch.column("text")):
                ids, bounds = encoder(vocabulary, spaces).encode(batch.column("text")[i:j])
                for k, doc_id in enumerate(batch.column("doc_id")[i:j].to_pylist()):
                    if writer is None:
                        system.create_dir(base, recursive=True)
                        path = f"{base}/shard-{task:06d}-{number:06d}.planes"
                        temporary = f"{path}.{uuid.uuid4().hex}"
                        sink = system.open_output_stream(temporary)
                        writer = ShardWriter(sink, planes, block)
                    writer.add(doc_id, np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id)))
                    if writer.n_ids >= shard_ids or len(writer.docs) >= shard_docs:
                        yield closed()
                        writer, number = None, number + 1
        if writer is not None:
            yield closed()
        release(vocabulary, spaces)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return staged(ordered.mapInArrow(run, "shard long, path string, n_ids long, n_docs long"), "shards")


def read_tokens(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """Every document of ``shards`` read back: doc_id, start (ids before it in the corpus), n_tokens, ids (uint32 bytes)."""
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = shards.select("shard", "path", F.coalesce(before, F.lit(0)).alias("start"))
    tasks = max(1, shards.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        system, _ = _system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(row["path"]) as source:
                    start, rows, held = row["start"], [], 0
                    for doc_id, ids in ShardReader(source).documents():
                        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                        start += len(ids)
                        held += len(ids)
                        if held >= 1 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return starts.repartitionByRange(tasks, "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
