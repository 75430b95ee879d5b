import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from starloom.llm import importance
from starloom.llm.importance import features, ranked, resampled
from tests.llm.edge_rows import DOCS_SCHEMA, edge_docs, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, longest=2):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def brute(rows, target, percent, least, longest, buckets, seed):
    s = Counter(bucket(f, buckets) for _, t in rows for f in grams(t, longest)[1])
    t = Counter(bucket(f, buckets) for x in target for f in grams(x, longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        words, own = grams(text, longest)
        weight = sum(gain[bucket(f, buckets)] for f in own) // len(own) if own else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, words, len(own), weight, score, None])
    may = sorted((r for r in out if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0], r[2]))
    for n, r in enumerate(may[: percent * len(may) // 100]):
        r[5] = n + 1
    return sorted(map(tuple, out), key=repr)


def test_buckets_of_a_batch_match_single_texts(monkeypatch):
    rng = random.Random(13)
    words = ["a", "B", "é", "中文", "x" * 64, "y" * 65, "z" * 300, "1", "\x00", "\x7f", "-", "ÀÉ", "w9"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(200)] + ["", "end", "\x00"]
    for longest in (1, 2, 4):
        counts, found = features([t.encode() for t in texts], longest, 977)
        assert counts.tolist() == [grams(t)[0] for t in texts]
        got = Counter((int(d), int(b)) for doc, bucket in found for d, b in zip(doc, bucket, strict=True))
        assert got == Counter((i, bucket(f, 977)) for i, t in enumerate(texts) for f in grams(t, longest)[1])


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(importance, "GROUP_BYTES", 500)
    rows = [(i % 90, sentence(i % 37, 10 + i % 50)) for i in range(120)] + [(r.doc_id, r.text) for r in edge_docs(spark).collect()]
    target = [sentence(k, 30) for k in range(3, 9)] + [None, ""]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, score int, rank int").repartition(4)
    for percent, least, longest, buckets in ((25, 20, 2, 10_000), (60, 1, 3, 50), (100, 0, 1, 7)):
        got = resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, least, longest, buckets, seed=7)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, target, percent, least, longest, buckets, 7)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS_SCHEMA)
    assert resampled(none, none).count() == 0
    docs = edge_docs(spark)
    assert resampled(docs, none).count() == docs.count() and resampled(docs, none, percent=0).where("rank IS NOT NULL").count() == 0


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).selectExpr("id", "CAST(id % 7 AS LONG) AS score")
    got = {r.id: r["rank"] for r in ranked(rows.repartition(16), rows["score"].desc(), rows["id"].asc()).collect()}
    expected = sorted(range(5000), key=lambda i: (-(i % 7), i))
    assert [got[i] for i in expected] == list(range(1, 5001))


def test_a_long_text_is_whole():
    text = "Word and other words, " * 400_000 + "x" * 5_000_000
    counts, found = features([text.encode()], 2, 10_000)
    assert counts.tolist() == [1_600_001] and [len(b) for _, b in found] == [1_600_001, 1_600_000]
    assert found[0][1][-1] == zlib.crc32(b"x" * 5_000_000) % 10_000 and np.bincount(found[1][0]).tolist() == [1_600_000]
