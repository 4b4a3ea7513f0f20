"""Connected components and helpers for pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import BROADCAST_ROWS, narrow
from assayer.session import pinned


EDGES_PER_TASK = 20_000
EDGES_AT_ONCE = BROADCAST_ROWS  # up to so many edges, 16 bytes each, one task names all components


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its smallest node.

    Up to ``EDGES_AT_ONCE`` edges are counted and then go to one task: every operation below takes several queries, whose
    plans, stages and broadcasts all stay with the driver for a time, however small they are.

    More edges alternate the large-star and the small-star operation until they are stars. All minima are aggregates that
    combine in the map tasks, and they are stored before the edges are joined to them, so that Spark can split a hot node.
    """
    edges = pinned(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"))
    if edges.count() <= EDGES_AT_ONCE:
        return pinned(edges.coalesce(1).mapInArrow(_named, "node bigint, component bigint"))
    edges = _stored(edges)
    seen = _fingerprint(edges)
    while seen[0]:
        # as many tasks as the edges need, whatever the number of shuffle partitions
        tasks = -(-seen[0] // EDGES_PER_TASK)
        both = edges.select(F.col("v").alias("x"), F.col("u").alias("y")).union(edges.select("u", "v"))
        least = both.groupBy("x").agg(F.min("y").alias("y")).select("x", F.least("x", "y").alias("m"))
        least = pinned(least.coalesce(tasks))
        large = edges.join(narrow(least.withColumnRenamed("x", "v")), "v").select("u", F.col("m").alias("v"))
        least = pinned(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks))
        small = large.join(narrow(least), "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = _stored(small.union(least.select("u", F.col("m").alias("v"))), tasks)
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pinned(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) for all nodes of the edges (u, v), which one task holds."""
    held = [np.stack([b.column(c).to_numpy().astype(np.int64) for c in ("u", "v")]) for b in batches if b.num_rows]
    if not held:
        return
    nodes, at = np.unique(np.concatenate(held, axis=1), return_inverse=True)
    u, v = at.reshape(2, -1)
    names = smallest(len(nodes), u, v)
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[names])], ["node", "component"])


def smallest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of 0 to n - 1 the smallest number connected with it by the edges (u, v)."""
    names = np.arange(n)
    while len(u):
        a, b = names[u], names[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(names, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(names, shorter := names[names]):
            names = shorter
    return names


def _stored(edges: DataFrame, tasks: int | None = None) -> DataFrame:
    found = edges.distinct()
    return pinned(found.coalesce(tasks) if tasks else found)


def _fingerprint(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal integer keys, from batches sorted by them. Holds one run and one batch at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        if held and tuple(values[:, 0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(values[:, -1])
    if held:
        yield pa.Table.from_batches(held)


class Sets:
    """Disjoint sets of 0 to n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
