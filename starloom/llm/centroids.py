"""Centroid clustering of whole-number vectors by scalar lookup tables.

Components are scaled and floored, so few different values occur. Vectors are staged once in
blocks: of each dimension the values that occur in the block, and for each vector the place
of its value among them. In every round a task tabulates the squared difference of each
dimension, occurring value and centroid; a distance is then a sum of table entries, gathered
by NumPy, and no component is subtracted twice.

A task returns sums and counts of its clusters, and the new centroids are a few rows on the
driver. All arithmetic is exact: in 64 bits where the largest values allow it, else in whole
numbers of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import staged

#: Vectors of a block; its places fit 16 bits.
BLOCK = 8192
LOWEST, LARGEST = -(1 << 63), (1 << 63) - 1
#: The largest number below 2^63 that a double holds, and where squares of differences still sum up in 64 bits.
LARGEST_DOUBLE, SMALL = float((1 << 63) - 1024), 1 << 27
BLOCK_SCHEMA = "ids array<bigint>, places binary, sizes array<int>, occurring binary"


def usable(vectors: DataFrame, dim: int) -> DataFrame:
    """(vec_id, embedding array<double>) of vectors with ``dim`` components, none null or non-finite."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    odd = F.exists("embedding", lambda x: x.isNull() | x.isNaN() | (F.abs(x) == float("inf")))
    return rows.where((F.size("embedding") == dim) & ~odd)


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), held within the range of a long."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), LOWEST, LARGEST_DOUBLE)


def _blocks(rows: DataFrame, dim: int, scale: float) -> DataFrame:
    """``rows`` (see ``usable``) in blocks: ids, places (uint16, vector by vector), and of each dimension
    how many values occur and which (doubles, ascending)."""

    def block(ids: list[pa.Array], parts: list[np.ndarray]) -> pa.RecordBatch:
        x = scaled(np.concatenate(parts), scale)
        places, occurring = np.empty(x.shape, "<u2"), []
        for d in range(dim):
            values, places[:, d] = np.unique(x[:, d], return_inverse=True)
            occurring.append(values)
        sizes = [len(v) for v in occurring]
        row = [pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())), pa.array([places.tobytes()], pa.binary())]
        row += [pa.array([sizes], pa.list_(pa.int32())), pa.array([np.concatenate(occurring).astype("<f8").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(row, ["ids", "places", "sizes", "occurring"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held = [], [], 0
        for batch in batches:
            x = batch.column("embedding").flatten().to_numpy().reshape(-1, dim)
            for i in range(0, len(x), BLOCK):
                if held + len(x[i : i + BLOCK]) > BLOCK:
                    yield block(ids, parts)
                    ids, parts, held = [], [], 0
                ids.append(batch.column("vec_id")[i : i + BLOCK])
                parts.append(x[i : i + BLOCK].copy())
                held += len(parts[-1])
        if held:
            yield block(ids, parts)

    return rows.mapInArrow(run, BLOCK_SCHEMA)


def first_centroids(rows: DataFrame, k: int, scale: float, seed: int) -> list[list[int]]:
    """The vectors of smallest sha256("seed:vec_id"), scaled; of rows that repeat a vec_id the smaller vector first."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    picked = rows.withColumn("h", named).orderBy("h", "embedding").limit(k).collect()
    return [[int(v) for v in scaled(np.array(r["embedding"]), scale)] for r in picked]


class Tables:
    """One block against centroids: squared differences of every dimension, occurring value and centroid."""

    def __init__(self, row: dict, centroids: list[list[int]]) -> None:
        sizes = np.array(row["sizes"])
        values = np.frombuffer(row["occurring"], "<f8")
        dims = np.repeat(np.arange(len(sizes)), sizes)
        small = max(np.abs(values).max(initial=0.0), max(abs(v) for c in centroids for v in c)) <= SMALL
        self.values = values.astype(np.int64) if small else np.array([int(v) for v in values], dtype=object)
        self.centroids = np.array(centroids, dtype=np.int64 if small else object)
        places = np.frombuffer(row["places"], "<u2").reshape(-1, len(sizes))
        self.at = places + (np.cumsum(sizes) - sizes)[None, :]
        self.table = (self.values[:, None] - self.centroids[:, dims].T) ** 2

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the nearest centroid, the first of equals, and its squared distance."""
        total = self.table[self.at[:, 0]]
        for d in range(1, self.at.shape[1]):
            total = total + self.table[self.at[:, d]]
        cluster = np.argmin(total, axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Component sums and sizes of the clusters."""
        out = np.zeros((k, self.at.shape[1]), dtype=self.values.dtype)
        for c in np.unique(cluster).tolist():
            out[c] = self.values[self.at[cluster == c]].sum(axis=0)
        return out, np.bincount(cluster, minlength=k)


def _summed(blocks: DataFrame, centroids: list[list[int]]) -> list[tuple[list[int], int]]:
    """For each centroid the component sums and the number of the vectors nearest to it."""
    k, dim = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                tables = Tables(batch.slice(i, 1).drop_columns(["ids"]).to_pylist()[0], centroids)
                own, n = tables.sums(tables.nearest()[0], k)
                total, count = total + own, count + n
        some = np.flatnonzero(count)
        columns = [
            pa.array(np.repeat(some, dim), pa.int32()), pa.array(np.tile(np.arange(dim), len(some)), pa.int32()),
            pa.array([Decimal(int(v)) for c in some for v in total[c]], pa.decimal128(38, 0)), pa.array(np.repeat(count[some], dim), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["c", "d", "total", "n"])

    parts = blocks.mapInArrow(run, "c int, d int, total decimal(38,0), n long")
    found = parts.groupBy("c", "d").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # k * dim rows at most
    out: list[tuple[list[int], int]] = [([0] * dim, 0) for _ in range(k)]
    for r in found:
        out[r["c"]][0][r["d"]] = int(r["total"])
        out[r["c"]] = (out[r["c"]][0], r["n"])
    return out


def _assigned(blocks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                cluster, distance = Tables(row.drop_columns(["ids"]).to_pylist()[0], centroids).nearest()
                far = distance if distance.dtype != object else [min(int(v), LARGEST) for v in distance]
                columns = [row.column("ids").flatten(), pa.array(cluster, pa.int32()), pa.array(far, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return blocks.mapInArrow(run, "vec_id long, cluster int, distance long")


def clustered(vectors: DataFrame, k: int = 8, dim: int = 64, scale: float = 1024.0, seed: int = 3, rounds: int = 10) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256) of the usable rows
    of ``vectors`` (vec_id, embedding; more columns are ignored), see ``usable``.

    Components count as floor(scale * x). Centroids start as the ``k`` vectors of smallest
    sha256("seed:vec_id"). Each of ``rounds`` rounds assigns every vector to the nearest, ties to
    the smaller number, and moves each centroid that has vectors to the floor of their mean;
    then all are assigned once more. distance is squared, an inertia its sum over the
    cluster or over all; centroid_sha256 is of the components as decimals joined by commas.

    Fewer vectors than ``k``: as many centroids. Repeated vec_ids: each row is a vector. Null
    vec_id: a vector too, hashed as "seed:". Scaled components beyond a long's range count as
    its ends, and so do distances and inertias. No usable row: no rows.

    The driver holds ``k`` centroids and, a round, their sums; a task one block and its tables.
    """
    rows = usable(vectors, dim)
    centroids = first_centroids(rows, k, scale, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>, centroid_sha256 string"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema)
    blocks = staged(_blocks(rows, dim, scale), "blocks")
    for _ in range(rounds):
        moved = [[t // n for t in total] if n else c for c, (total, n) in zip(centroids, _summed(blocks, centroids), strict=True)]
        if moved == centroids:
            break  # so would every further round
        centroids = moved
    found = staged(_assigned(blocks, centroids), "assigned")
    sums = {r["cluster"]: int(r["inertia"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    inertia = min(sum(sums.values()), LARGEST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    described = [(c, min(v, LARGEST), inertia, centroids[c], digests[c]) for c, v in sums.items()]
    names = T.StructType([f for f in T._parse_datatype_string(schema).fields if f.name not in ("vec_id", "distance")])
    return found.join(F.broadcast(vectors.sparkSession.createDataFrame(described, names)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"
    )
