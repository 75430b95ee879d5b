import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from starloom.llm import encoding
from starloom.llm.encoding import Encoder
from starloom.llm.packing import SumOfSquares, packed
from starloom.llm.tokens import ShardReader, ShardWriter, read_tokens, shuffled, unshuffled, write_tokens
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize(("path", "spaces"), [(WORD, "dropped"), (BYTE, "leading"), (BYTE, None)])
def test_word_by_word_gives_the_ids_of_whole_texts(path, spaces):
    rng = random.Random(1)
    texts = ["", None, "a", " lead", "trail ", "a\nb", "a\n\n\nb", "it's <|endoftext|> x<|endoftext|>", "\x1c a \x1d", "x　y  z", "ΑΣ ΣΑΣ", "é ́x", "q" * 3000]
    texts += ["".join(rng.choice("ab \n\t '.,1é ") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    whole, own = Tokenizer.from_file(path), Encoder(path, spaces)
    for part in (pa.array(texts), pa.array(texts)[3:200], pa.array(texts[:0], pa.string())):
        ids, bounds = own.encode(part)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [whole.encode(t or "", add_special_tokens=False).ids for t in part.to_pylist()]


@pytest.mark.parametrize(("path", "spaces"), [(WORD, "dropped"), (BYTE, "leading")])
def test_words_remembered_across_calls_keep_their_ids(path, spaces, monkeypatch):
    """Marks behind words, odd blanks, special tokens; with a memory that overflows at every call."""
    monkeypatch.setattr(encoding, "REMEMBERED", 40)
    rng = random.Random(2)
    parts = ["word", "Word,", "end.", "wow!!!", "a%$,", "don't", "it's.", "É,", "ß;", "x1,", "1.", "...", "a...b", "\u200b", "\ufeff", "<|endoftext|>", "a<|endoftext|>,", " ", "\n", "中,", "e\u0301,", "q" * 50]
    whole, own = Tokenizer.from_file(path), Encoder(path, spaces)
    for kept in (30, 5, 0, 1000):
        texts = [" ".join(rng.choice(parts) + rng.choice(["", "", str(rng.randint(0, 99))]) for _ in range(rng.randint(0, 25))) for _ in range(150)]
        ids, bounds = own.encode(pa.array(texts))
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        own.keep(kept)
        assert len(own.known) <= max(kept, 0) or kept == 1000
        assert list(own.known.values()) == list(range(len(own.known))) and len(own.uses) <= len(own.known)


@pytest.mark.parametrize(("path", "spaces"), [(WORD, "dropped"), (BYTE, "leading")])
def test_a_distinct_word_is_looked_up_once_a_call(path, spaces):
    class Counted(dict):
        looked = 0

        def get(self, *a):
            Counted.looked += 1
            return super().get(*a)

        def __contains__(self, word):
            Counted.looked += 1
            return super().__contains__(word)

        def __getitem__(self, word):
            Counted.looked += 1
            return super().__getitem__(word)

    own, texts = Encoder(path, spaces), ["w%d of the\n%d words" % (i % 50, i % 7) for i in range(500)]
    first = own.encode(pa.array(texts))
    own.known = Counted(own.known)
    for kind in (pa.string(), pa.large_string()):
        Counted.looked = 0
        again = own.encode(pa.array(texts, kind))
        assert all((a == b).all() for a, b in zip(first, again, strict=True))
        firsts = len(texts) if spaces == "leading" else 0
        assert 0 < Counted.looked <= 50 + 2 + 2 * 7 + 1 + firsts


def test_most_used_words_stay():
    own = Encoder(WORD, "dropped")
    own.encode(pa.array(["a b c c c d d", "c e"]))
    own.keep(2)
    assert set(own.known) == {"c", "d"}


@pytest.mark.parametrize("size", [8, 64, 2048])
def test_packing_fills_every_window(size):
    rng = random.Random(size)
    for n in (0, 1, 2, 50, 400):
        docs = {i: rng.choice([1, size, rng.randint(1, size), rng.randint(1, 5 * size)]) for i in range(n)}
        packer, pieces = SumOfSquares(size), []
        for d, length in docs.items():
            pieces += packer.add(d, length)
        pieces += packer.finish()
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for d, start, length, sequence, offset in pieces:
            by_doc[d].append((start, length))
            by_sequence[sequence].append((offset, length))
        for parts, total in [(by_doc[d], n) for d, n in docs.items()] + [(p, None) for p in by_sequence.values()]:
            at = 0
            for start, length in sorted(parts):
                assert start == at and length > 0
                at += length
            assert at == total if total else at == size or at & (at - 1) == 0


def test_level_with_the_smallest_sum_of_squares():
    packer = SumOfSquares(10)
    packer.count[[3, 6, 9]] = [4, 1, 2]

    def grown(level, n):
        count = packer.count.copy()
        count[level] -= level > 0
        if level + n < 10:
            count[level + n] += 1
        return (count**2).sum()

    for n in range(1, 10):
        choices = [0] + [x for x in (3, 6, 9) if x + n <= 10]
        assert grown(packer._level(n), n) == min(grown(x, n) for x in choices)


def test_packed_pieces_are_the_documents(spark):
    docs = edge_docs(spark)
    tokenizer = Tokenizer.from_file(WORD)
    rows = [r.asDict() for r in packed(docs, WORD, "dropped", 1, 64).collect()]
    expected = sorted(np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes() for r in docs.collect())
    # Rows of one doc_id are told apart by following their pieces in order.
    starts = sorted((r for r in rows if r["start"] == 0), key=lambda r: r["ids"])
    assert len(starts) == len(expected) and sum(r["length"] for r in rows) * 4 == sum(map(len, expected))
    fill = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"]
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or at & (at - 1) == 0
    unique = {k: b"".join(r["ids"] for r in sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["start"])) for k in (1, 5, 6, 9, 12)}
    for r in docs.where("doc_id IN (1, 5, 6, 9, 12)").collect():
        assert unique[r.doc_id] == np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
    assert packed(spark.createDataFrame([], DOCS_SCHEMA), WORD, "dropped", 1).count() == 0


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_planes_round_trip(planes):
    rng = np.random.default_rng(2)
    for ids in (rng.integers(0, 1 << 16, 1000), np.array([0, (1 << 32) - 1, 5]), np.zeros(9, int), np.array([7])):
        ids = ids.astype(np.uint32)
        assert (unshuffled(shuffled(ids, planes), len(ids)) == ids).all()


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_shards_round_trip_and_single_blocks(tmp_path, planes):
    rng = np.random.default_rng(3)
    docs = [(d, rng.integers(0, 60_000, n).astype(np.uint32)) for d, n in [(4, 0), (None, 3), (9, 1000), (9, 1), (12, 129)]]
    system = fs.LocalFileSystem()
    with system.open_output_stream(str(tmp_path / "s")) as sink:
        writer = ShardWriter(sink, planes, block=128)
        for d, ids in docs:
            writer.add(d, ids)
        writer.close()
    with system.open_input_file(str(tmp_path / "s")) as source:
        reader = ShardReader(source)
        got = list(reader.documents())
        assert [d for d, _ in got] == [d for d, _ in docs]
        assert all((a == b).all() and len(a) == len(b) for (_, a), (_, b) in zip(got, docs, strict=True))
        every = np.concatenate([ids for _, ids in docs])
        assert (reader.chunk(3) == every[384:512]).all()
    with system.open_output_stream(str(tmp_path / "cut")) as sink:
        sink.write((tmp_path / "s").read_bytes()[:-9])
    with system.open_input_file(str(tmp_path / "cut")) as source, pytest.raises(ValueError, match="shard"):
        ShardReader(source)


@pytest.mark.parametrize(
    ("shard_ids", "shard_docs"),
    [(1 << 28, 1 << 20), (50, 1 << 20), (1, 1 << 20), (1 << 28, 1)],
    ids=["one a task", "several a task", "one a document", "one a document by number"],
)
def test_write_and_read_edge_rows(spark, tmp_path, shard_ids, shard_docs):
    docs, tokenizer = edge_docs(spark), Tokenizer.from_file(BYTE)
    folder = f"file://{tmp_path}/tokens"
    shards = write_tokens(docs, folder, BYTE, "leading", 2, block=100, shard_ids=shard_ids, shard_docs=shard_docs)
    assert shards.count() == docs.count() if 1 in (shard_ids, shard_docs) else shards.count() <= 8 + 2 * (shard_ids == 50) * docs.count()
    assert shards.agg({"n_docs": "sum"}).first()[0] == docs.count()
    rows = sorted(read_tokens(spark, shards, folder).collect(), key=lambda r: r.start)
    crc = lambda t: zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
    assert sorted(((r.doc_id, zlib.crc32(r.ids)) for r in rows), key=repr) == sorted(((r.doc_id, crc(r.text)) for r in docs.collect()), key=repr)
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    empty = write_tokens(spark.createDataFrame([], DOCS_SCHEMA), f"file://{tmp_path}/none", BYTE, "leading", 2)
    assert read_tokens(spark, empty, f"file://{tmp_path}/none").count() == 0
