"""Embedding near-dedup by lattice hashing.

A vector's direction is projected to 8 * ``BLOCKS`` random coordinates a table; each 8 are
decoded to the nearest point of the E8 lattice, and the points name the vector's cell. A vector
is at home in its cell and probes the cells of neighbouring lattice points. Two vectors of one
label meet where one is at home and the other is at home or probes; cosines are verified
there in double precision.

A pair that meets in several cells is counted in the first of them only, which both vectors'
directions tell, so nothing has to be gathered to remove repeats. A task takes blocks of a
cell and gives each vector's links and a spanning forest, never the pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import components, staged

#: Tables, E8 blocks of a table, lattice neighbours probed in each block, and the scale of a cell.
TABLES, BLOCKS, NEIGHBOURS, SCALE = 3, 2, 4, 1.3
#: Vectors of a cell that one side of a comparison takes, on average.
CELL_BLOCK = 512


@lru_cache(maxsize=1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    halves = itertools.product((0.5, -0.5), repeat=8)
    return np.array(out + [np.array(v) for v in halves if sum(x < 0 for x in v) % 2 == 0])


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest points of whole numbers with an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points of the rows of ``x``."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


@lru_cache(maxsize=4)
def _projections(dim: int) -> np.ndarray:
    random = np.random.Generator(np.random.PCG64(dim))
    return random.normal(size=(TABLES, BLOCKS, dim, 8)) * (SCALE / np.sqrt(8))


@lru_cache(maxsize=1)
def _names() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 62, (BLOCKS, 8), dtype=np.int64) * 2 + 1


def cells(unit: np.ndarray) -> np.ndarray:
    """Names of the cells of unit vectors: vector x table x cell, the home first and then the probes."""
    n, dim = unit.shape
    out = np.zeros((n, TABLES, (1 + NEIGHBOURS) ** BLOCKS), dtype=np.int64)
    for t in range(TABLES):
        parts = []
        for b in range(BLOCKS):
            x = unit @ _projections(dim)[t, b]
            home = decode(x)
            distance = ((x - home)[:, None, :] - roots()[None]) ** 2
            near = np.argsort(distance.sum(2), axis=1, kind="stable")[:, :NEIGHBOURS]
            points = np.concatenate([home[:, None], home[:, None] + roots()[near]], axis=1)
            with np.errstate(over="ignore"):
                parts.append((np.rint(points * 2).astype(np.int64) * _names()[b]).sum(2))
        names = parts[0]
        for part in parts[1:]:
            names = ((names[:, :, None] * 31) ^ part[:, None, :]).reshape(n, -1)
        out[:, t] = names
    return out


def _units(body: list[bytes]) -> np.ndarray:
    x = np.array([np.frombuffer(b, "<f8") for b in body])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _in_blocks(bodies: list[bytes], most: int = 2000) -> Iterator[tuple[int, np.ndarray]]:
    for i in range(0, len(bodies), most):
        yield i, _units(bodies[i : i + most])


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the links ``a``-``b`` among ``n`` nodes."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, body) of the rows that may link: body holds the components as doubles."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    fine = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0").where(
        ~F.exists("embedding", lambda x: x.isNull() | x.isNaN() | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            # Adding zero makes -0.0 equal to 0.0.
            values, offsets = lists.flatten().to_numpy().astype("<f8") + 0.0, lists.offsets.to_numpy() - lists.offsets[0].as_py()
            bodies = [values[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(bodies, pa.binary())], ["vec_id", "label", "body"])

    return fine.mapInArrow(run, "vec_id long, label long, body binary")


def _celled(distinct: DataFrame) -> DataFrame:
    """(rep, label, dim, t, cell, home) of every cell that a vector of ``distinct`` is in or probes."""
    width = (1 + NEIGHBOURS) ** BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(b) // 8 for b in batch.column("body").to_pylist()])
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                bodies = part.column("body").to_pylist()
                for i, unit in _in_blocks(bodies):
                    n = len(unit)
                    names = cells(unit)
                    rows = np.repeat(np.arange(i, i + n), TABLES * width)
                    columns = [
                        part.column("rep").take(pa.array(rows)), part.column("label").take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)),
                        pa.array(np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), width), n)), pa.array(names.reshape(-1)),
                        pa.array(np.tile(np.arange(width) == 0, n * TABLES)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["rep", "label", "dim", "t", "cell", "home"])

    return distinct.select("rep", "label", "body").mapInArrow(run, "rep long, label long, dim int, t int, cell long, home boolean")


def _met(a: np.ndarray, b: np.ndarray, t: int, cell: int) -> np.ndarray:
    """Whether pairs of cells (row i of ``a`` with row i of ``b``) meet in ``cell`` of table ``t`` and in no cell before."""
    ab = (a[:, :, :1] == b).any(2)  # a's home is b's home or probe, by table
    ba = (b[:, :, :1] == a).any(2)
    first = ~(ab | ba)[:, :t].any(1)
    home_a, home_b = a[:, t, 0], b[:, t, 0]
    least = np.where(ab[:, t] & ba[:, t], np.minimum(home_a, home_b), np.where(ab[:, t], home_a, home_b))
    return first & (least == cell)


def lattice_links(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Rows link if their labels are equal, their cosine is at least ``cosine`` and they meet in a
    cell; equal vectors of a label always do. n_links counts other rows linked directly;
    component_id is the smallest vec_id reachable; kept marks the rows that have it.

    Equal vectors of a label are one node, so copies are counted and not compared. Null
    labels, and vectors that are null, empty, zero, or hold null or non-finite components,
    link with nothing; vectors of different lengths do not either. Null vec_id: links with
    nothing, component_id and kept are null. Repeated vec_ids: each row is a vector. Empty
    table: no rows.
    """
    rows = staged(usable(vectors).withColumn("h", F.xxhash64("body")), "usable")
    distinct = staged(rows.groupBy("label", "h", "body").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "distinct")
    # One vec_id may stand for several vectors; nodes need names of their own.
    nodes = staged(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    every = staged(_celled(nodes.select(F.col("node").alias("rep"), "label", "body")), "cells")
    where = ["label", "dim", "t", "cell"]
    counts = every.groupBy(*where).agg(F.count("*").alias("n"), F.max("home").alias("homes")).where("homes AND n > 1")
    met = every.join(counts, where).withColumn("blocks", F.ceil(F.col("n") / CELL_BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int")
    spread = met.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    units = spread.select(
        *where, F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "home", F.col("rep").alias("node")
    ).join(nodes.select("node", "body", "copies"), "node")

    def compare(unit: pa.Table) -> pa.Table:
        node, home, copies, block = (unit.column(c).to_numpy() for c in ("node", "home", "copies", "block"))
        t, cell = unit.column("t")[0].as_py(), unit.column("cell")[0].as_py()
        one, two = unit.column("one")[0].as_py(), unit.column("two")[0].as_py()
        order = np.argsort(node)
        node, home, copies, block = node[order], home[order], copies[order], block[order]
        bodies = unit.column("body").to_pylist()
        x = _units([bodies[i] for i in order])
        names: np.ndarray | None = None
        links, from_a, from_b = np.zeros(len(node), np.int64), [], []
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        for i in range(0, len(left), 256):
            rows = left[i : i + 256]
            hit = (x[rows] @ x[right].T >= cosine) & (home[rows][:, None] | home[right][None])
            hit &= node[rows][:, None] < node[right][None] if one == two else node[rows][:, None] != node[right][None]
            a, b = np.nonzero(hit)
            a, b = rows[a], right[b]
            if not len(a):
                continue
            if names is None:
                names = np.concatenate([cells(x[k : k + 500]) for k in range(0, len(x), 500)])
            for k in range(0, len(a), 20_000):
                p, q = a[k : k + 20_000], b[k : k + 20_000]
                new = _met(names[p], names[q], t, cell)
                np.add.at(links, p[new], copies[q[new]])
                np.add.at(links, q[new], copies[p[new]])
            from_a.append(a)
            from_b.append(b)
        empty = np.zeros(0, np.int64)
        a, b = forest(np.concatenate(from_a or [empty]), np.concatenate(from_b or [empty]), len(node))
        some = np.flatnonzero(links)
        return pa.table(
            {
                "a": pa.array(np.concatenate([node[some], node[a]])),
                "b": pa.array(np.concatenate([np.full(len(some), -1), node[b]])),
                "links": pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)])),
            }
        )

    found = staged(units.groupBy(*where, "one", "two").applyInArrow(compare, "a long, b long, links long"), "found")
    links = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(found.where("b >= 0").select("a", "b"))
    named = nodes.select("node", "label", "h", "body", "rep", "copies").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Staged, so that the join has a plain shuffle on both sides, which AQE can split at a large component.
    smallest = staged(named.groupBy("component").agg(F.min("rep").alias("component_id")), "smallest")
    labelled = named.join(smallest, "component").join(links, "node", "left")
    by_node = labelled.select("label", "h", "body", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    placed = rows.join(by_node, ["label", "h", "body"]).select("vec_id", "n_links", "component_id")
    ids = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    alone = ids.where(
        F.col("vec_id").isNull() | F.col("label").isNull() | F.col("embedding").isNull() | (F.size("embedding") == 0)
        | F.coalesce(F.exists("embedding", lambda x: x.isNull() | x.isNaN() | (F.abs(x) == float("inf"))), F.lit(False))
        | ~F.coalesce(F.exists("embedding", lambda x: x.isNotNull() & (x != 0)), F.lit(False))
    ).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.union(alone).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
