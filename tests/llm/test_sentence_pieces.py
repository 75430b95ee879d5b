import random
import resource

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from starloom.llm import sentence_pieces
from starloom.llm.sentence_pieces import Pieces, decoded, encoded
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_ids_and_texts_match_the_library():
    rng = random.Random(3)
    texts = ["", None, " ", "  ", "a", "   lead", "trail   ", "a  b   c", " " * 40, "x" * 300, "ab" * 200, "中" * 100, "<s> </s> <0x41>", "�"]
    texts += ["".join(rng.choice("ab the,.é1▁ \n 😀中日ñ\x00<s>") for _ in range(rng.randint(0, 60))) for _ in range(800)]
    library, own = sentencepiece.SentencePieceProcessor(model_file=MODEL), Pieces(MODEL)
    for part in (pa.array(texts), pa.array(texts)[5:90], pa.array(texts[:0], pa.string())):
        ids, bounds = own.encode(part)
        expected = [library.encode(t or "") for t in part.to_pylist()]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == expected
        assert own.decode(ids.astype(np.int64), bounds) == [library.decode(e) for e in expected]


def test_edges_are_all_occurrences_in_order():
    own = Pieces(MODEL)
    text = "▁the▁other▁then"
    start, length, piece = own.edges(np.array([ord(c) for c in text], np.uint32))
    names = {own.names[i]: i for i in own.ids.tolist()}
    expected = [(i, j - i, names[text[i:j]]) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in names]
    assert list(zip(start.tolist(), length.tolist(), piece.tolist(), strict=True)) == expected


def test_operator_on_edge_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = edge_docs(spark).withColumnRenamed("__other", "ids_before")
    rows = decoded(encoded(docs, MODEL, carry=("doc_id", "key")), MODEL).collect()
    got = [(r.doc_id, r.key, np.frombuffer(r.ids, "<i4").tolist(), r.text) for r in rows]
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "")
        expected.append((r.doc_id, 7, ids, library.decode(ids)))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert encoded(spark.createDataFrame([], DOCS_SCHEMA), MODEL).count() == 0


def test_long_words_are_cut_where_no_piece_reaches_over(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(sentence_pieces, "LONG_WORD", 300)
    monkeypatch.setattr(sentence_pieces, "SEARCHED", 700)
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    vocabulary = Pieces(model)
    for alphabet in ("abcdefghijklmnopqrstuvwxyz", "etaoinshr", "中文字的一是不了人我在", "a", "x中"):
        word = "".join(rng.choice(alphabet) for _ in range(5000))
        parts = list(vocabulary._cut(word))
        assert "".join(parts) == word and (len(parts) > 3 or alphabet in ("a", "etaoinshr"))
        text = f"short {word} words {word[:400]}"
        ids, _ = vocabulary.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text)


def test_memory_of_a_long_word():
    """A million characters without a blank, far below a full table for them."""
    rng = np.random.default_rng(6)
    word = "".join(map(chr, rng.integers(0x4E00, 0x5E00, 1_000_000)))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    vocabulary = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    ids, bounds = vocabulary.encode(pa.array([word]))
    assert vocabulary.decode(ids, bounds) == [word]
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300
