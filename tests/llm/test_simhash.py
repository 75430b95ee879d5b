import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from starloom.llm.common import components
from starloom.llm.simhash import fingerprint_links, fingerprints, simhash_components, simhash_dedup, text_groups, xxh64
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs, stored

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def brute_fingerprint(text, k):
    words = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def brute_components(prints, ids, bits):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    out = {}
    for i, d in enumerate(ids):
        if d is not None:
            out[find(i)] = min(out.get(find(i), d), d)
    return [out.get(find(i)) for i in range(len(ids))]


def test_hash_of_slices_of_any_length():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 6000).astype(np.uint8)
    start, length = rng.integers(0, 4000, 400), rng.integers(0, 1800, 400)
    expected = [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), 42) for a, n in zip(start, length, strict=True)]
    assert xxh64(data, start, length).tolist() == expected


def test_fingerprints_match_the_definition():
    texts = ["", None, "a", "A B", "  x\ty\n", "É é ß", "one two three four five SIX", "w " * 500, "a\x0bb\x0cc\x1cd"]
    for k in (1, 4, 5):
        groups = text_groups(pa.array(texts), 20)
        got = np.concatenate([fingerprints(data, bounds, k) for _, _, data, bounds in groups])
        assert got.tolist() == [brute_fingerprint(t, k) for t in texts]


def test_links_are_all_pairs_within_the_distance(spark):
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, (1 << 64) - 1}
    for c in centres:
        for _ in range(12):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 6)):
                x ^= 1 << b
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    for bits in (1, 3, 4, 6):
        rows = fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), bits).distinct().collect()
        got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in rows}
        assert got == {frozenset((p, q)) for p in prints for q in prints if p < q and (p ^ q).bit_count() <= bits}


def test_components_of_chains_hubs_and_nulls(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(8, 60)] + [(1, 1), (None, 2), (3, None), (5, 4), (4, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), **dict.fromkeys(range(7, 60), 7), 4: 4, 5: 4}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_operator_on_edge_rows(spark):
    docs = edge_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text, 4) for r in rows]
    expected = zip((r.doc_id for r in rows), (f"{p:016x}" for p in prints), brute_components(prints, [r.doc_id for r in rows], 4), strict=True)
    got = [tuple(r) for r in simhash_components(docs).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], DOCS_SCHEMA)).count() == 0


def test_dedup_keeps_one_row_of_each_component(spark, tmp_path):
    rng = random.Random(31)
    words = [rng.choice("abcdefghij") * rng.randint(1, 9) + str(k) for k in range(400)]
    near = " ".join(words[:200] + ["changed"] + words[200:])
    rows = [(4, " ".join(words)), (4, " ".join(words)), (3, near), (3, "an other text under the same id"), (None, "an other text under the same id")]
    rows += [(None, "without id"), (None, "without id"), (9, None), (8, " "), (None, "")]
    docs = stored(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, __key int").repartition(4), tmp_path / "d")
    prints = [brute_fingerprint(t, 4) for _, t in rows]
    assert (prints[0] ^ prints[2]).bit_count() <= 4  # else the fixture says nothing
    kept = sorted(((r.doc_id, r.text) for r in simhash_dedup(docs.drop("__key")).collect()), key=repr)
    assert kept == sorted([(3, near), (3, "an other text under the same id"), (None, "without id"), (8, " ")], key=repr)
    assert simhash_dedup(spark.createDataFrame([], DOCS_SCHEMA)).count() == 0
