import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from starloom.llm import suffix
from starloom.llm.suffix import anchors, matching_statistics, repeated_passages, repeated_spans, suffix_dedup, suffix_order
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs, stored


def brute(texts, length):
    """For each text its removed spans and the bytes that stay."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        edges = [i for i in range(len(d) + 1) if (i > 0 and gone[i - 1]) != (i < len(d) and gone[i])]
        out.append((list(zip(edges[::2], edges[1::2], strict=True)), bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out


def passages(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    shared = [" ".join(word() for _ in range(k)) for k in (5, 12, 30, 60)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40))))
        texts.append(" ".join(parts))
    return texts + ["ab" * 300, "ab" * 120 + "c", texts[0], "", None, "spam " * 90]


def test_suffix_order():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 300):
        x = rng.integers(1, 3, n).astype(np.uint64)
        assert suffix_order(x).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


def test_streamed_statistics_are_the_longest_matches():
    rng = random.Random(2)
    for _ in range(40):
        pieces = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        slots = np.array([rng.randint(0, 2) for _ in pieces])
        best, firsts, runs = matching_statistics(pieces, slots)
        assert 1 <= runs <= len(best)
        for p, piece in enumerate(pieces):
            for i in range(len(piece)):
                longest = 0
                for q, other in enumerate(pieces):
                    j = i + int(slots[p] - slots[q])
                    if q != p and 0 <= j < len(other):
                        n = 0
                        while i + n < len(piece) and j + n < len(other) and piece[i + n] == other[j + n]:
                            n += 1
                        longest = max(longest, n)
                assert best[firsts[p] + i] == longest
    assert repeated_spans([], np.zeros(0, int), 4) == []


def test_equal_windows_hold_equal_anchors():
    texts = [t.encode() for t in passages(3) if t]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    at, h = anchors(data, bounds, 60, 16)
    hashes = dict(zip(at.tolist(), h.tolist(), strict=True))
    seen = {}
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        for i in range(s, e - 60 + 1):
            window = data[i : i + 60].tobytes()
            own = {(p - i, hashes[p]) for p in range(i, i + 45) if p in hashes}
            assert own
            # Which anchors fall in a window also depends on its neighbours, the smallest does not.
            least = min(own, key=lambda x: (x[1] >> 32, x[0]))
            assert seen.setdefault(window, least) == least


@pytest.mark.parametrize("indexed", [256, 1], ids=["indexed", "halved"])
def test_removed_bytes_match_brute_force(spark, tmp_path, monkeypatch, indexed):
    monkeypatch.setattr(suffix, "INDEXED", indexed)
    texts = passages(5)
    docs = stored(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3), tmp_path / "d")
    rows = {r.doc_id: r for r in suffix_dedup(docs, length=60, anchor=16).collect()}
    for i, (spans, kept) in enumerate(brute(texts, 60)):
        assert [(x.start, x.end) for x in rows[i].removed] == spans
        assert bytes(rows[i].kept) == kept and rows[i].n_bytes == len((texts[i] or "").encode())


def test_edge_rows_and_whole_characters(spark, tmp_path):
    docs = stored(edge_docs(spark), tmp_path / "d")
    texts = [r.text for r in docs.collect()]
    got = sorted(hashlib.sha256(bytes(r.kept)).hexdigest() for r in suffix_dedup(docs, carry=("doc_id", "key", "fp")).collect())
    assert got == sorted(hashlib.sha256(k).hexdigest() for _, k in brute(texts, 200))
    cut = stored(spark.createDataFrame([(1, "é" * 150), (2, "x" + "é" * 150 + "中")], "doc_id long, text string"), tmp_path / "c")
    for r in suffix_dedup(cut, characters=True).collect():
        assert bytes(r.kept).decode() in ("", "x中", "x", "中")


def test_empty_table_and_bad_anchor(spark, tmp_path):
    none = spark.createDataFrame([], DOCS_SCHEMA)
    assert suffix_dedup(none).count() == 0
    with pytest.raises(ValueError, match="anchor"):
        repeated_passages(none, length=20, anchor=20)
