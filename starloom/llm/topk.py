"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length into buckets a fixed factor apart, and buckets into chunks of
bounded size. The longest vectors give every query a first lower bound of its k-th score. That
bound, the query's length and the bucket's longest vector give a local cosine threshold:
above 1 the chunk cannot hold a better vector; high thresholds are met by few values of
the query's largest coordinate, so that coordinate prunes; low ones leave only the
vectors' own lengths to prune by. What remains is verified by whole products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import staged

#: Rows of a chunk or query block on average, and how many buckets a doubling of the length has.
CHUNK, QUERY_BLOCK, STEPS = 4096, 4096, 4
#: Longest vectors that give the first bounds, which each task gets: at most so many, and so many bytes.
SEEDS, SEED_BYTES = 2048, 4 << 20
#: Local cosine from which the largest coordinate prunes, and the slack of a bound.
COORDINATE_FROM, SLACK = 0.5, 1e-9
LARGEST = (1 << 63) - 1


def scaled_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, dim, norm, bucket, body) of usable rows: body holds floor(scale * x) as doubles.

    Rows of null vec_id, null or empty vectors, and null or non-finite components are left out.
    """
    rows = vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    )
    rows = rows.where(~F.exists("embedding", lambda x: x.isNull() | x.isNaN() | (F.abs(x) == float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            values = np.floor(scale * lists.flatten().to_numpy())
            size = np.diff(lists.offsets.to_numpy())
            starts = np.concatenate([[0], np.cumsum(size)])[:-1]
            largest = np.maximum.reduceat(np.abs(values), starts) if len(values) else np.zeros(0)
            unit = np.where(largest > 0, largest, 1.0)
            norm = unit * np.sqrt(np.add.reduceat((values / np.repeat(unit, size)) ** 2, starts)) if len(values) else largest
            bucket = np.where(norm > 0, np.floor(STEPS * np.log2(np.where(norm > 0, norm, 1.0))), -1).astype(np.int32)
            bodies = [values[s : s + n].astype("<f8").tobytes() for s, n in zip(starts, size, strict=True)]
            columns = [batch.column("vec_id"), pa.array(size, pa.int32()), pa.array(norm), pa.array(bucket), pa.array(bodies, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "norm", "bucket", "body"])

    return rows.mapInArrow(run, "vec_id long, dim int, norm double, bucket int, body binary")


def products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two arrays of whole numbers, as long; beyond its range, its ends."""
    bound = np.abs(p).max(initial=0.0) * np.abs(q).max(initial=0.0) * p.shape[1]
    if bound < 2.0**53:
        return (p @ q.T).astype(np.int64)
    exact = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in q.tolist()] for x in p.tolist()]
    return np.array([[max(-LARGEST - 1, min(LARGEST, v)) for v in row] for row in exact], dtype=np.int64).reshape(len(p), len(q))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= cut)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))][:k]


def chunk_search(
    qid: np.ndarray, q: np.ndarray, q_norm: np.ndarray, bound: np.ndarray, ids: np.ndarray, p: np.ndarray, p_norm: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the ids and scores of a chunk's k best that reach ``bound`` (NaN: none)."""
    order = np.argsort(-p_norm)
    ids, p, p_norm = ids[order], p[order], p_norm[order]
    longest = p_norm[0] if len(p_norm) else 0.0
    unit = p / np.where(p_norm > 0, p_norm, 1.0)[:, None]
    dense = []
    for i in range(len(qid)):
        product = q_norm[i] * longest
        if np.isnan(bound[i]) or bound[i] <= 0 or not np.isfinite(product):
            dense.append(i)
            continue
        local = bound[i] / product if product > 0 else np.inf
        if local > 1 + SLACK:
            continue
        if local < COORDINATE_FROM:
            dense.append(i)
            continue
        f = int(np.argmax(np.abs(q[i])))
        x = q[i, f] / q_norm[i]
        half = np.sqrt(max(0.0, (1 - min(1.0, local) ** 2) * (1 - x * x))) + 1e-7
        low, high = x * local - half, x * local + half
        if x > local:  # a longer cosine than asked for is possible up to the axis itself
            high = 1.0
        elif -x > local:
            low = -1.0
        rows = np.flatnonzero((unit[:, f] >= low) & (unit[:, f] <= high))
        rows = rows[(p_norm[rows] * q_norm[i] >= bound[i] * (1 - SLACK)) & (ids[rows] != qid[i])]
        scores = products(p[rows], q[i : i + 1])[:, 0]
        rows, scores = rows[scores >= bound[i]], scores[scores >= bound[i]]
        top = best(scores, ids[rows], k)
        yield i, ids[rows[top]], scores[top]
    # Low thresholds: the chunk is sorted by length, so a prefix is left for each query.
    for j in range(0, len(dense), 512):
        rows = np.array(dense[j : j + 512])
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            least = np.where(bound[rows] > 0, bound[rows] * (1 - SLACK) / q_norm[rows], 0.0)
        reach = np.where(np.isnan(least), len(ids), np.searchsorted(-p_norm, -np.nan_to_num(least), "right"))
        scores = products(p[: reach.max()], q[rows])
        for n, i in enumerate(rows.tolist()):
            own = scores[: reach[n], n]
            ok = ids[: reach[n]] != qid[i]
            if not np.isnan(bound[i]):
                ok &= own >= bound[i]
            at = np.flatnonzero(ok)
            top = best(own[at], ids[at], k)
            yield i, ids[at[top]], own[at[top]]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best among ``vectors``, its own vec_id left out.

    Both frames have vec_id and embedding; components count as floor(scale * x) and the score
    is their inner product, exact, ties to the smaller vec_id. Vectors meet only vectors of
    their own number of components. Unusable rows (see ``scaled_vectors``) take no part;
    a zero vector takes part with score 0. Of repeated vec_ids each row is a candidate; queries
    of one vec_id share one ranking of what all of them find. Empty tables: no rows.

    Queries are taken in blocks and candidates in chunks of bounded size; each pair of the
    two is one unit of work, so no task holds more than one of each. Queries of a block need
    about the same length of a vector to reach their bounds: a query goes only to buckets whose
    longest vector can, and a vector only to blocks of queries that need no longer ones. Fewer
    seeds, as for very wide vectors, make bounds looser and the result no other.
    """
    candidates, asked = staged(scaled_vectors(vectors, scale), "vectors"), staged(scaled_vectors(queries, scale), "queries")
    widest = candidates.agg(F.max("dim")).first()[0] or 1
    seeds = candidates.orderBy(F.desc("norm"), "vec_id").limit(min(SEEDS, SEED_BYTES // (8 * widest))).select("vec_id", "dim", "body").collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in seeds}:
        rows = [r for r in seeds if r["dim"] == dim]
        by_dim[dim] = np.array([r["vec_id"] for r in rows]), np.array([np.frombuffer(r["body"], "<f8") for r in rows])

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds = []
            for vec_id, dim, body in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "dim", "body")), strict=True):
                ids, p = by_dim.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim))))
                scores = products(p[ids != vec_id], np.frombuffer(body, "<f8")[None])[:, 0]
                bounds.append(float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bounds, pa.float64())], [*batch.schema.names, "bound"])

    asked = staged(asked.mapInArrow(bounded, "vec_id long, dim int, norm double, bucket int, body binary, bound double"), "bounds")
    # The bucket of the shortest vector that can reach the bound; a little less, so that rounding loses none.
    need = F.expr(f"CASE WHEN bound > 0 AND norm > 0 THEN CAST(floor({STEPS} * log2(bound * (1 - {2 * SLACK}D) / norm)) AS INT) END")
    asked = asked.withColumn("need", F.coalesce(need, F.lit(-(1 << 31))))
    blocks = asked.groupBy("dim", "need").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    needs = blocks.groupBy("dim").agg(F.collect_list(F.struct("need", "blocks")).alias("needs"))
    chunks = candidates.groupBy("dim", "bucket").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.max("norm").alias("longest"))
    every = chunks.groupBy("dim").agg(F.collect_list(F.struct("bucket", "chunks", "longest")).alias("buckets"))
    chunks = chunks.drop("longest")
    # Negated, so that a product that is no number keeps its bucket.
    reached = f"filter(buckets, b -> bound IS NULL OR bound <= 0 OR NOT coalesce(norm * b.longest < bound * (1 - {SLACK}D), false))"
    hashed = F.xxhash64("vec_id", F.lit(7))
    left = (
        asked.join(blocks, ["dim", "need"]).join(every, "dim")
        .withColumn("block", F.pmod(hashed, F.col("blocks")).cast("int"))
        .withColumn("at", F.explode(F.expr(f"flatten(transform({reached}, b -> transform(sequence(0, b.chunks - 1), c -> struct(b.bucket AS bucket, c AS chunk))))")))
        .select("dim", "need", "block", "at.bucket", "at.chunk", F.lit(True).alias("asks"), "vec_id", "norm", "body", "bound")
    )
    right = (
        candidates.join(chunks, ["dim", "bucket"]).join(needs, "dim")
        .withColumn("chunk", F.pmod(hashed, F.col("chunks")).cast("int"))
        .withColumn("to", F.explode(F.expr("flatten(transform(filter(needs, x -> x.need <= bucket), x -> transform(sequence(0, x.blocks - 1), b -> struct(x.need AS need, b AS block))))")))
        .select("dim", "to.need", "to.block", "bucket", "chunk", F.lit(False).alias("asks"), "vec_id", "norm", "body", F.lit(None).cast("double").alias("bound"))
    )

    def search(unit: pa.Table) -> pa.Table:
        dim = unit.column("dim")[0].as_py() if len(unit) else 0
        asks = unit.column("asks").to_numpy()
        ids, norm = unit.column("vec_id").to_numpy(), unit.column("norm").to_numpy()
        bound = unit.column("bound").to_numpy().astype(float)
        body = np.frombuffer(b"".join(unit.column("body").to_pylist()), "<f8").reshape(-1, dim) if dim else np.zeros((0, 0))
        found = list(chunk_search(ids[asks], body[asks], norm[asks], bound[asks], ids[~asks], body[~asks], norm[~asks], k))
        q = ids[asks]
        return pa.table(
            {
                "query_id": pa.array(np.repeat([q[i] for i, _, _ in found], [len(v) for _, v, _ in found]) if found else [], pa.int64()),
                "vec_id": pa.array(np.concatenate([v for _, v, _ in found]) if found else [], pa.int64()),
                "score": pa.array(np.concatenate([s for _, _, s in found]) if found else [], pa.int64()),
            }
        )

    units = left.union(right).groupBy("dim", "need", "block", "bucket", "chunk")
    found = units.applyInArrow(search, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
