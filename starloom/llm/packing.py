"""Sum-of-squares packing of token ids into fixed windows.

Documents are placed online: the fill level that receives one is chosen so that the sum of
squared counts of partially filled windows grows least. The counts live in one array over
levels, so a placement costs one vector operation over at most ``size`` entries.

Documents may be cut. One longer than a window fills whole windows first and only its rest
is placed. The most recent documents are held back, just enough to fill every open window;
at the end they are cut to do so, and what is left over is cut into whole windows and then
powers of two, which need no padding. So each partition of the input is packed on its own,
without a shuffle, and ends without padding (tests hold it to that).
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import sparing
from starloom.llm.encoding import byte_slices, encoder, release

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: Bytes of text encoded together.
GROUP_BYTES = 4 << 20


class SumOfSquares:
    """Window filling of one partition. Pieces: (doc, start, length, sequence, offset)."""

    def __init__(self, size: int, first_sequence: int = 0) -> None:
        self.size, self.next = size, first_sequence
        self.count = np.zeros(size + 1, dtype=np.int64)  # open windows by fill level
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.room = 0  # free places in all open windows
        self.held: deque[tuple[object, int]] = deque()
        self.held_ids = 0

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _level(self, n: int) -> int:
        """The level to receive ``n`` ids; 0 is a new window. Of equal levels the fullest."""
        top = self.size - n
        if not top:
            return 0
        old, new = self.count[: top + 1], self.count[n:]
        cost = 2 * (new - old) + 2
        cost[0] = 2 * new[0] + 1
        cost[top] = 1 - 2 * old[top]
        cost[1:][old[1:] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(cost[::-1]))

    def _place(self, doc: object, n: int) -> Iterator[tuple[object, int, int, int, int]]:
        at = 0
        while n - at >= self.size:
            yield doc, at, self.size, self._new(), 0
            at += self.size
        if n > at:
            rest = n - at
            level = self._level(rest)
            sequence = self.open[level].pop() if level else self._new()
            self.count[level] -= bool(level)
            yield doc, at, rest, sequence, level
            if level + rest < self.size:
                self.open[level + rest].append(sequence)
                self.count[level + rest] += 1
            self.room += (0 if level else self.size) - rest

    def add(self, doc: object, n: int) -> Iterator[tuple[object, int, int, int, int]]:
        self.held.append((doc, n))
        self.held_ids += n
        while self.held and self.held_ids - self.held[0][1] >= self.room + self.size:
            doc, n = self.held.popleft()
            self.held_ids -= n
            yield from self._place(doc, n)

    def finish(self) -> Iterator[tuple[object, int, int, int, int]]:
        """Cut the documents held back into the open windows, then into whole and power-of-two ones."""
        gaps = [(s, level, self.size - level) for level in range(1, self.size) for s in self.open[level]]
        left = self.held_ids - sum(g for _, _, g in gaps)
        while left > 0:
            n = self.size if left >= self.size else 1 << (left.bit_length() - 1)
            gaps.append((self._new(), 0, n))
            left -= n
        slots = deque(gaps)
        for doc, n in self.held:
            at = 0
            while at < n:
                sequence, offset, free = slots.popleft()
                take = min(free, n - at)
                yield doc, at, take, sequence, offset
                at += take
                if take < free:
                    slots.appendleft((sequence, offset + take, free - take))
        self.held.clear()


def packed(docs: DataFrame, vocabulary: str, spaces: str | None, end_id: int, size: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length, ids (little-endian
    uint32), doc_tokens (with the end id), sequence_id, offset (place in the sequence).

    ``docs`` has doc_id and text; more columns are ignored. A sequence id is the partition's
    number times 2^33 plus a count, so a task that is run again gives the same rows.

    Null and empty texts are one end id. A document of any length is cut. Repeated doc_ids
    and null ones: each row is a document of its own. Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquares(size, TaskContext.get().partitionId() << 33)
        rows: list[tuple] = []

        def take(pieces: Iterator) -> None:
            for (doc_id, ids), start, length, sequence, offset in pieces:
                rows.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids), sequence, offset))

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            rows.clear()
            return batch

        for batch in batches:
            for i, j in byte_slices(batch.column("text"), GROUP_BYTES):
                ids, bounds = encoder(vocabulary, spaces).encode(batch.column("text")[i:j])
                for k, doc_id in enumerate(batch.column("doc_id")[i:j].to_pylist()):
                    own = np.append(ids[bounds[k] : bounds[k + 1]], np.uint32(end_id)).astype("<u4")
                    take(packer.add((doc_id, own), len(own)))
                yield out()
        take(packer.finish())
        release(vocabulary, spaces)
        yield out()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sparing(run), PIECES)
