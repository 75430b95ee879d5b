"""SentencePiece encoding and decoding by suffix-array matching.

For a batch of texts:

1. Texts are cut at spaces, which no piece of such a vocabulary reaches over, and each
   different word is taken once. The words, joined, are the text to index.
2. A suffix array of that text is built, to the depth of the longest piece, and every piece is
   found in it by binary search: a range of occurrences.
3. The occurrences are edges from position to position. Sorted by position they fill a table
   of start and length.
4. Relaxation. A BPE model does not add up scores along a path; it joins the best
   neighbours first. So all words are relaxed side by side: each step joins, in every word,
   the two neighbouring edges that a single edge of best score can replace (the leftmost of
   equals), until no edge spans two neighbours.

Characters without a piece become their UTF-8 byte pieces. Tests hold ids and decoded texts
against the sentencepiece library.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.encoding import byte_slices

SPACE = "▁"
#: Characters indexed together, and the word length up to which words are relaxed side by side.
INDEXED, SIDE_BY_SIDE = 200_000, 48
REMEMBERED = 400_000
#: Words longer than that are cut where no piece occurs across; characters searched for cuts at once, and remembered.
LONG_WORD, SEARCHED, REMEMBERED_CHARS = 20_000, 200_000, 20_000_000


class Pieces:
    """A BPE vocabulary with byte fallback; remembers words it has encoded."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, -1, np.int64)
        plain = []
        for i, name in enumerate(self.names):
            if model.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append(i)
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary has no byte fallback")
        if any(SPACE in self.names[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece reaches over a space")
        if model.normalize("a \t b") != "▁a▁\t▁b":
            raise ValueError("the model normalizes; only white space may be escaped")
        # Pieces by length in code points; scores ranked so that a smaller rank joins first.
        by_score = sorted(plain, key=lambda i: -model.get_score(i))
        self.rank = np.full(n, np.iinfo(np.int32).max, np.int32)
        place, last = -1, None
        for i in by_score:
            if (score := model.get_score(i)) != last:
                place, last = place + 1, score
            self.rank[i] = place
        self.ids = np.array(plain)
        self.size = np.array([len(self.names[i]) for i in plain])
        self.longest = int(self.size.max())
        self.chars = np.zeros((len(plain), self.longest), np.uint32)
        for row, i in enumerate(plain):
            self.chars[row, : self.size[row]] = [ord(c) for c in self.names[i]]
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held_chars = 0
        self.pool = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)

    # -- 2: index

    def suffix_array(self, text: np.ndarray) -> np.ndarray:
        """Positions of ``text`` (code points) ordered by the characters that a piece can reach."""
        n, known = len(text), 2
        key = (text.astype(np.uint64) << np.uint64(32)) | np.concatenate([text[1:], [0]]).astype(np.uint64)
        while True:
            order = np.argsort(key)
            fresh = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
            if known >= self.longest or fresh.all():
                return order
            rank = np.empty(n, np.uint64)
            rank[order] = np.cumsum(fresh, dtype=np.uint64)
            after = np.zeros(n, np.uint64)
            after[: max(0, n - known)] = rank[known:]
            key = (rank << np.uint64(32)) | after
            known *= 2

    def _occurrences(self, text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every piece the range of ``order`` whose suffixes it begins, by binary search."""
        padded = np.concatenate([text, np.zeros(self.longest, np.uint32)])
        pair = (padded[order].astype(np.uint64) << np.uint64(32)) | padded[order + 1]
        begin = (self.chars[:, 0].astype(np.uint64) << np.uint64(32)) | self.chars[:, 1]
        end = begin + np.where(self.size == 1, np.uint64(1 << 32), np.uint64(1))
        first, last = np.searchsorted(pair, begin), np.searchsorted(pair, end)
        column = np.arange(self.longest)
        for upper in (False, True):
            # Pieces of three characters and more: on within what begins with their first two.
            low, high = first.copy(), last.copy()
            open_ = np.flatnonzero((self.size > 2) & (low < high))
            while len(open_):
                middle = (low[open_] + high[open_]) // 2
                chars = self.chars[open_]
                own = padded[order[middle][:, None] + column]
                differs = (own != chars) & (column[None] < self.size[open_][:, None])
                at, some = differs.argmax(1), differs.any(1)
                rows = np.arange(len(open_))
                right = np.where(some, own[rows, at] < chars[rows, at], upper)
                low[open_[right]] = middle[right] + 1
                high[open_[~right]] = middle[~right]
                open_ = open_[low[open_] < high[open_]]
            searched = self.size > 2
            if upper:
                last = np.where(searched, low, last)
            else:
                below = np.where(searched, low, first)
        return below, last

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and piece of every occurrence in ``text``, sorted by start and length."""
        order = self.suffix_array(text)
        low, high = self._occurrences(text, order)
        times = high - low
        total = np.concatenate([[0], np.cumsum(times)])
        start = order[np.arange(total[-1]) + np.repeat(low - total[:-1], times)]
        length, piece = np.repeat(self.size, times), np.repeat(self.ids, times)
        by_place = np.argsort(start * (self.longest + 1) + length)
        return start[by_place], length[by_place], piece[by_place]

    # -- 4: relax

    def _relaxed(self, table: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the symbols of words side by side: for word w, ``ends[w, :count[w]]`` relative to its start."""
        n, width = len(first), int(size.max(initial=1))
        worst = np.iinfo(np.int32).max
        ends = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        count = size.copy()
        column = np.arange(width)

        def joined(rows: np.ndarray, k: np.ndarray) -> np.ndarray:
            """Rank of the edge over symbols k and k + 1 of each row."""
            ok = (k >= 0) & (k + 1 < count[rows])
            k = np.where(ok, k, 0)
            start = np.where(k > 0, ends[rows, np.maximum(k - 1, 0)], 0)
            length = ends[rows, np.minimum(k + 1, width - 1)] - start
            ok &= length <= self.longest
            piece = table[first[rows] + start, np.where(ok, length, 0)]
            return np.where(ok & (piece >= 0), self.rank[piece], worst)

        cost = np.full((n, width), worst, np.int32)
        for k in range(width - 1):
            rows = np.flatnonzero(count > k + 1)
            cost[rows, k] = joined(rows, np.full(len(rows), k))
        live = np.arange(n)
        while len(live):
            k = cost[live].argmin(1)
            some = cost[live, k] < worst
            live, k = live[some], k[some]
            if not len(live):
                break
            # Symbols k and k + 1 become one: everything after moves one to the left.
            take = column[None] + (column[None] >= k[:, None])
            take = np.minimum(take, width - 1)
            ends[live] = np.take_along_axis(ends[live], take, 1)
            shifted = np.take_along_axis(cost[live], take, 1)
            shifted[:, -1] = worst
            cost[live] = shifted
            count[live] -= 1
            cost[live, k] = joined(live, k)
            has = k > 0
            cost[live[has], k[has] - 1] = joined(live[has], k[has] - 1)
        return ends, count

    def _relaxed_long(self, table: np.ndarray, first: int, size: int) -> list[int]:
        """Ends of the symbols of one long word, by a heap of joins."""
        after, before, end = list(range(1, size + 1)), list(range(-1, size - 1)), list(range(1, size + 1))
        gone = [False] * size
        heap: list[tuple[int, int, int]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < size:
                stop = end[after[k]]
                if stop - k <= self.longest and (piece := table[first + k, stop - k]) >= 0:
                    heapq.heappush(heap, (int(self.rank[piece]), k, stop))

        for k in range(size):
            offer(k)
        while heap:
            _, k, stop = heapq.heappop(heap)
            if gone[k] or after[k] >= size or end[after[k]] != stop:
                continue
            old = after[k]
            gone[old], end[k], after[k] = True, stop, after[old]
            if after[old] < size:
                before[after[old]] = k
            offer(before[k])
            offer(k)
        return [end[k] for k in range(size) if not gone[k]]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` joined, and how many each has."""
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.concatenate([[0], np.cumsum(size)])[:-1]
        start, length, piece = self.edges(text)
        table = np.full((len(text) + 1, self.longest + 1), -1, np.int32)
        table[start, length] = piece
        counts = np.zeros(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # words, and the ends of their symbols
        short = np.flatnonzero(size <= SIDE_BY_SIDE)
        short = short[np.argsort(size[short], kind="stable")]
        for i in range(0, len(short), 8192):
            part = short[i : i + 8192]
            ends, counts[part] = self._relaxed(table, first[part], size[part])
            done.append((part, ends[np.arange(ends.shape[1])[None] < counts[part][:, None]]))
        for w in np.flatnonzero(size > SIDE_BY_SIDE):
            ends = np.array(self._relaxed_long(table, int(first[w]), int(size[w])), np.int64)
            counts[w] = len(ends)
            done.append((np.array([w]), ends))
        place = np.cumsum(counts) - counts
        stop = np.zeros(int(counts.sum()), np.int64)
        for part, ends in done:
            n = counts[part]
            stop[np.arange(len(ends)) + np.repeat(place[part] - (np.cumsum(n) - n), n)] = ends
        word = np.repeat(np.arange(len(words)), counts)
        begin = np.concatenate([[0], stop[:-1]])
        begin[np.concatenate([[True], word[1:] != word[:-1]])[: len(stop)]] = 0
        ids = table[first[word] + begin, stop - begin].astype(np.int64)
        lost = np.flatnonzero(ids < 0)  # single characters without a piece
        if not len(lost):
            return ids, counts
        sizes = np.ones(len(ids), np.int64)
        spelled = [self.byte_ids[list(chr(text[first[word[j]] + begin[j]]).encode())] for j in lost]
        sizes[lost] = [len(b) for b in spelled]
        out = np.repeat(ids, sizes)
        at = np.cumsum(sizes) - sizes
        for j, b in zip(lost.tolist(), spelled, strict=True):
            out[at[j] : at[j] + len(b)] = b
        totals = np.zeros(len(words), np.int64)
        np.add.at(totals, word, sizes)
        return out, totals

    def _cut(self, word: str) -> Iterator[str]:
        """Parts of a long word, cut where no piece occurs across: no join can reach over such a place.

        Parts have about ``LONG_WORD`` characters, or more where pieces overlap without an end.
        """
        done = 0
        for low in range(0, len(word), SEARCHED):
            begin = max(0, low - self.longest)
            stop = min(len(word), low + SEARCHED + self.longest)
            start, length, _ = self.edges(np.frombuffer(word[begin:stop].encode("utf-32-le"), np.uint32))
            crossed = np.zeros(stop - begin + 2, np.int64)
            np.add.at(crossed, start + 1, 1)
            np.add.at(crossed, start + length, -1)
            free = np.flatnonzero(np.cumsum(crossed) == 0) + begin
            for at in free[(free > low) & (free <= low + SEARCHED)].tolist():
                if at - done >= LONG_WORD and at < len(word):
                    yield word[done:at]
                    done = at
        yield word[done:]

    def _encoded_long(self, word: str) -> np.ndarray:
        found: list[np.ndarray] = []
        group, chars = [], 0
        for part in self._cut(word):
            if chars + len(part) > INDEXED and group:
                found.append(self._encoded(group)[0])
                group, chars = [], 0
            group.append(part)
            chars += len(part)
        return np.concatenate([*found, self._encoded(group)[0]])

    def _indices(self, words: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.known))
        i = 0
        while i < len(new):
            j, chars = i, 0
            while j < len(new) and len(new[j]) <= LONG_WORD and (j == i or chars + len(new[j]) <= INDEXED):
                chars += len(new[j])
                j += 1
            if j == i:
                ids, chars, j = self._encoded_long(new[i]), len(new[i]), i + 1
                counts = np.array([len(ids)])
            else:
                ids, counts = self._encoded(new[i:j])
            self.held_chars += chars
            n, filled = len(self.known), int(self.ends[len(self.known)])
            while n + j - i + 1 > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            while filled + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.ends[n + 1 : n + 1 + j - i] = filled + np.cumsum(counts)
            self.pool[filled : filled + len(ids)] = ids
            self.known.update(zip(new[i:j], range(n, n + j - i), strict=True))
            i = j
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as int32 and the bounds of each text among them. Null is an empty text."""
        if len(self.known) > REMEMBERED or self.held_chars > REMEMBERED_CHARS:
            self._forget()
        texts = pa.array(texts).fill_null("")
        # A word is a run of spaces with what follows it, so only the last of a run cuts.
        marked = pc.replace_substring(texts, " ", SPACE)
        full = marked.filter(pc.not_equal(marked, ""))
        cut = pc.replace_substring_regex(full, f"([^{SPACE}]){SPACE}", r"\1 " + SPACE)
        words = pc.split_pattern(pc.binary_join_element_wise(pa.scalar(SPACE), cut, ""), " ")
        coded = words.flatten().dictionary_encode()
        at = self._indices(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        sizes = self.ends[at + 1] - self.ends[at]
        to = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.arange(to[-1]) + np.repeat(self.ends[at] - to[:-1], sizes)]
        own = np.zeros(len(texts), np.int64)
        offsets = words.offsets.to_numpy().astype(np.int64)
        own[pc.not_equal(marked, "").to_numpy(zero_copy_only=False)] = np.diff(to[offsets - offsets[0]])
        return ids, np.concatenate([[0], np.cumsum(own)])

    # -- decoding

    @cached_property
    def _spelling(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces, and their bounds. Control and unknown pieces spell nothing."""
        single = {int(i): bytes([b]) for b, i in enumerate(self.byte_ids)}
        plain = set(self.ids.tolist())
        parts = [single.get(i, self.names[i].replace(SPACE, " ").encode() if i in plain else b"") for i in range(len(self.names))]
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of runs of ids. A leading space is the encoder's own; bytes that are no UTF-8 become U+FFFD."""
        letters, ends = self._spelling
        sizes = (ends[1:] - ends[:-1])[ids]
        to = np.concatenate([[0], np.cumsum(sizes)])
        data = letters[np.arange(to[-1]) + np.repeat(ends[ids] - to[:-1], sizes)].tobytes()
        cuts = to[bounds].tolist()
        return [data[s:e].decode(errors="replace").removeprefix(" ") for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


_VOCABULARIES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """This worker's vocabulary of a model file; it outlives a task."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Pieces(path)
    return _VOCABULARIES[path]


def encoded(docs: DataFrame, model: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of ``docs`` and ids, those of its text (little-endian int32, binary).

    Whole texts are encoded, without marks of begin and end. Null and empty texts: no ids.
    Null and repeated doc_ids: one row each. A long text is indexed by its different words, and a
    long word by parts that no piece reaches over; only a run without any such place, as of one
    letter, takes some 400 bytes a character. One pass, no shuffle. Empty table: no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            for i, j in byte_slices(batch.column("__text"), 4 << 20):
                ids, bounds = vocabulary.encode(batch.column("__text")[i:j])
                data = pa.py_buffer(ids.astype("<i4").tobytes())
                body = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer((bounds * 4).tobytes()), data]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[i:j] for c in carry), body], [*carry, "ids"])

    rows = docs.select(*carry, F.col("text").cast("string").alias("__text"))
    return rows.mapInArrow(run, T.StructType([*(docs.schema[c] for c in carry), T.StructField("ids", T.BinaryType())]))


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` (doc_id, ids, any further columns) with text, what ids spell; null ids spell nothing. ids stay."""
    schema = rows.select("*", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        for batch in batches:
            bodies = batch.column("ids").fill_null(b"")
            for i, j in byte_slices(bodies, 8 << 20):
                part = [x.as_buffer() for x in bodies[i:j]]
                ids = np.concatenate([np.frombuffer(b, "<i4") for b in part]).astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum([b.size // 4 for b in part])])
                yield pa.RecordBatch.from_arrays([*(c[i:j] for c in batch.columns), pa.array(vocabulary.decode(ids, bounds))], [*batch.schema.names, "text"])

    return rows.mapInArrow(run, schema)
