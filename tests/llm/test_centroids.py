import hashlib
import math

import numpy as np
import pytest

from starloom.llm import centroids
from starloom.llm.centroids import LARGEST, LOWEST, clustered

VECTORS = "vec_id long, embedding array<double>, label int, cluster int, ids string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 5, "x") for i, v in rows], VECTORS).repartition(parts)


def brute(rows, k, dim, scale, seed, rounds):
    """(vec_id, cluster, distance, cluster_inertia, inertia, sha256) in whole numbers of any size."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, [max(LOWEST, min(math.floor(scale * x), int(centroids.LARGEST_DOUBLE))) for x in v]) for i, v in kept]
    named = sorted(range(len(kept)), key=lambda n: (hashlib.sha256(f"{seed}:{'' if kept[n][0] is None else kept[n][0]}".encode()).hexdigest(), kept[n][1]))
    middle = [ints[n][1] for n in named[:k]]

    def assign():
        out = []
        for _, v in ints:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in middle]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        at = assign()
        for c in range(len(middle)):
            own = [v for (_, v), (a, _) in zip(ints, at, strict=True) if a == c]
            if own:
                middle[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    at = [(c, min(d, LARGEST)) for c, d in assign()]
    total = min(sum(d for _, d in at), LARGEST)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    return sorted(((i, c, d, min(LARGEST, sum(e for b, e in at if b == c)), total, sha[c]) for (i, _), (c, d) in zip(ints, at, strict=True)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.drop("centroid").collect()), key=repr)


@pytest.mark.parametrize("block", [8192, 7], ids=["one block", "many blocks"])
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=4) + 3 * (i % 5)).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(7, rows[1][1]), (7, rows[2][1]), (None, rows[5][1])]
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0, None, 1.0, 1.0]), (304, [math.nan] * 4), (305, [math.inf, 0.0, 0.0, 0.0]), (306, [-0.0] * 4)]
    for k, rounds in ((1, 1), (5, 3), (8, 10)):
        assert got(clustered(frame(spark, rows), k=k, dim=4, scale=16.0, seed=3, rounds=rounds)) == brute(rows, k, 4, 16.0, 3, rounds)


def test_large_components_are_exact_and_end_at_the_range(spark):
    rows = [(i, [(i - 5) * 1e12 + 0.5, 3.0]) for i in range(12)] + [(20, [1e300, 0.0]), (21, [-1e300, 0.0]), (22, [2.0**62, 1.0])]
    assert got(clustered(frame(spark, rows), k=3, dim=2, rounds=4)) == brute(rows, 3, 2, 1024.0, 3, 4)


def test_ties_empty_clusters_and_few_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(20)]  # all centroids equal: the first has all, the others stay
    assert got(clustered(frame(spark, same), k=4, dim=2)) == brute(same, 4, 2, 1024.0, 3, 10)
    few = [(1, [0.0, 1.0]), (2, [4.0, 1.0])]
    result = clustered(frame(spark, few), k=8, dim=2)
    assert got(result) == brute(few, 8, 2, 1024.0, 3, 10)
    assert sorted(r.centroid for r in result.collect()) == [[0, 1024], [4096, 1024]]


def test_no_usable_row(spark):
    for rows in ([], [(1, [1.0])]):
        empty = clustered(frame(spark, rows), dim=64)
        assert empty.count() == 0 and empty.columns == clustered(frame(spark, [(1, [1.0])]), dim=1).columns
