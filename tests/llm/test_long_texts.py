"""Texts of 20 MB: words, no blank at all, odd blanks. Results are held against plain ways where these are affordable."""

import hashlib
import re
import resource

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import suffix
from starloom.llm.encoding import Encoder
from starloom.llm.suffix import suffix_dedup
from starloom.llm.tokens import read_tokens, write_tokens
from tests.llm.edge_rows import stored

MB = 1 << 20


def words(n, seed=1):
    rng = np.random.default_rng(seed)
    letters = rng.integers(97, 123, n).astype(np.uint8)
    letters[np.cumsum(rng.integers(2, 9, n // 5))[: n // 8] % n] = 32
    return letters.tobytes().decode()


def test_a_long_text_with_odd_blanks_is_cut_at_plain_ones():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = re.sub(" +", " ", words(3 * MB)).strip().replace(" ab", "​ab").replace(" ba", "\x1c ba")
    own = Encoder(path, "leading")
    ids, _ = own.encode(pa.array([text]))
    assert len(own.known) > 1000 and ids.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("size", [20 * MB])
def test_tokens_of_a_long_text_come_back(spark, tmp_path, size):
    text = words(size)
    docs = spark.createDataFrame([(1, text), (2, "next")], "doc_id long, text string")
    folder = f"file://{tmp_path}/t"
    shards = write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), "leading", 2)
    rows = {r.doc_id: r for r in read_tokens(spark, shards, folder).collect()}
    decoded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).decode(np.frombuffer(rows[1].ids, "<u4")[:-1].tolist(), skip_special_tokens=False)
    assert decoded == text and rows[2].start == rows[1].n_tokens


def test_anchors_of_parts_are_those_of_the_whole(spark, tmp_path, monkeypatch):
    """Passages across the seams of parts: the parts are made small instead of the text long."""
    base = words(30_000)
    text = base[:20_000] + words(9_000, 2) + base[4_000:17_000]
    docs = stored(spark.createDataFrame([(1, text), (2, base[19_500:19_900]), (3, "x" * 3_000)], "doc_id long, text string"), tmp_path / "d")
    whole = {r.doc_id: (r.removed, bytes(r.kept)) for r in suffix_dedup(docs).collect()}
    monkeypatch.setattr(suffix, "GROUP_BYTES", 1_000)
    parts = {r.doc_id: (r.removed, bytes(r.kept)) for r in suffix_dedup(docs).collect()}
    assert parts == whole and len(whole[1][0]) == 3 and len(whole[3][1]) == 0


def test_passages_of_a_long_text(spark, tmp_path):
    text = words(20 * MB)
    docs = stored(spark.createDataFrame([(1, text), (2, text[5 * MB : 5 * MB + 1_000] + "end")], "doc_id long, text string"), tmp_path / "d")
    rows = {r.doc_id: r for r in suffix_dedup(docs).collect()}
    assert [(x.start, x.end) for x in rows[1].removed] == [(5 * MB, 5 * MB + 1_000)] and bytes(rows[2].kept) == b"end"
    assert hashlib.sha256(bytes(rows[1].kept)).digest() == hashlib.sha256((text[: 5 * MB] + text[5 * MB + 1_000 :]).encode()).digest()


def test_memory_of_anchors_is_bounded(spark):
    """The parts' working memory does not grow with the text."""
    data = np.frombuffer(words(16 * MB).encode(), np.uint8)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for s in range(0, len(data), suffix.GROUP_BYTES):
        part = data[s : s + suffix.GROUP_BYTES + 199]
        suffix.anchors(part, np.array([0, len(part)]), 200, 48)
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 400
