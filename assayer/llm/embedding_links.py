"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Vectors are scaled to unit length, where a cosine is a Euclidean distance. A hash is floor((a . x + b) / ``WIDTH``) for a
Gaussian direction a; a table joins several of them into one bucket key. How many follows from the number n of distinct
vectors: so many that unrelated vectors share a bucket with probability 1 / n, then so many tables that a pair at the
threshold meets in one of them with probability ``RECALL``. Nearer pairs meet more often.

Equal vectors are one vector with copies. Buckets of one vector are dropped before vectors travel. Large buckets are dealt
into blocks of ``BLOCK`` vectors, and each pair of blocks is one unit of work. A unit gives one row for each vector: its
links that no earlier table has found, and the root of its linked group, never a row for each pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import picked
from assayer.llm.components import Sets, components, runs
from assayer.session import pinned

WIDTH = 1.6
RECALL = 0.995
BLOCK = 128
SEED = 20_240_501
_MIX = np.uint64(0x9E3779B97F4A7C15)


def meeting(distance: float, width: float = WIDTH) -> float:
    """The probability that one hash is equal for two points at a distance."""
    t = width / distance
    tail = 0.5 * math.erfc(t / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def hashes_and_tables(vectors: int, threshold: float) -> tuple[int, int]:
    """Hashes in a table and tables, for so many distinct vectors. Unrelated vectors are at a right angle."""
    hashes = max(1, math.ceil(math.log(max(2, vectors)) / -math.log(meeting(math.sqrt(2)))))
    near = meeting(math.sqrt(2 - 2 * threshold)) ** hashes if threshold < 1 else 1.0
    return hashes, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - near))) if near < 1 else 1


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def bucket_keys(vectors: np.ndarray, groups: np.ndarray, hashes: int, tables: int) -> np.ndarray:
    """One key for each vector (row) and table; ``groups`` are hashes of what two vectors must have in common."""
    draw = np.random.default_rng([SEED, vectors.shape[1]])
    directions = draw.standard_normal((vectors.shape[1], tables * hashes))
    offsets = draw.uniform(0, WIDTH, tables * hashes)
    cells = np.floor((unit(vectors) @ directions + offsets) / WIDTH).astype(np.int64).view(np.uint64)
    keys = (groups.view(np.uint64)[:, None] + np.arange(1, tables + 1, dtype=np.uint64)) * _MIX
    for k in range(hashes):
        keys = (keys ^ cells[:, k::hashes]) * _MIX
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], hashes: int, tables: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array([len(v) for v in batch.column("vector")])
        keys = np.zeros((len(sizes), tables), dtype=np.int64)
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            vectors = batch.column("vector").take(pa.array(own)).flatten().to_numpy().reshape(len(own), size)
            keys[own] = bucket_keys(vectors, batch.column("common").to_numpy()[own], hashes, tables)
        column = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "keys"])


def _links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for rows in runs(batches, ["key", "low", "high"]):
        if rows.num_rows < 2:
            continue
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        vectors = rows["vector"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        keys = rows["keys"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        block, table = rows["block"].to_numpy(), rows["place"][0].as_py()
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        norms = np.linalg.norm(vectors, axis=1)
        near = (vectors @ vectors.T) / np.outer(norms, norms) >= threshold
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        if low != high:
            near &= block[:, None] != block[None, :]
        i, j = np.nonzero(np.triu(near, 1))
        first = ~(keys[i, :table] == keys[j, :table]).any(axis=1)
        i, j = i[first], j[first]
        links = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
        sets = Sets(len(node))
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            sets.join(a, b)
        linked = np.flatnonzero(links)
        roots = np.array([sets.find(a) for a in linked.tolist()], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[linked]), pa.array(links[linked].astype(np.int64)), pa.array(node[roots])], ["node", "links", "root"]
        )


def linked(
    embeddings: DataFrame, threshold: float = 0.98, id_column="vec_id", vector_column="embedding", label_column: str | None = "label"
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (it names its component).

    Vectors are compared in double precision and only where labels are equal and not null (``label_column=None``: all) and
    lengths are equal. A vector that is null, empty or zero, or holds a null, NaN or infinite component, links with nothing
    and is its own component; so does a row without an id, whose component is null. Rows that repeat an id with the same
    vector count as copies; if their vectors differ, they share one component and the sum of their links. An empty table
    gives no rows.
    """
    label = {"label": label_column} if label_column else {}
    rows = picked(embeddings, node=id_column, vector=vector_column, **label)
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    if not label_column:
        rows = rows.withColumn("label", F.lit(0))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    usable = usable & F.col("label").isNotNull() & F.col("node").isNotNull()
    rows = rows.withColumn("vector", F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0))))
    groups = rows.where(F.col("vector").isNotNull()).groupBy("label", "vector")
    groups = groups.agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("copies"))
    distinct = pinned(groups.withColumn("common", F.xxhash64("label", F.size("vector"))))
    hashes, tables = hashes_and_tables(distinct.count(), threshold)
    plain = distinct.select("node", "copies", "common", "vector")
    schema = "node bigint, copies bigint, common bigint, vector array<double>, keys array<bigint>"
    signed = pinned(plain.mapInArrow(lambda batches: _signed(batches, hashes, tables), schema))
    buckets = signed.select("node", "common", F.posexplode("keys").alias("place", "key"))
    shared = pinned(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = buckets.join(shared, "key").withColumns({"block": F.pmod(F.xxhash64("node"), blocks).cast("int"), "blocks": blocks})
    dealt = dealt.join(signed, ["node", "common"]).select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    dealt = dealt.select("key", "low", "high", "block", "place", "node", "copies", "vector", "keys")
    order = ["key", "low", "high"]
    found = dealt.repartition(*order).sortWithinPartitions(*order)
    found = pinned(found.mapInArrow(lambda batches: _links(batches, threshold), "node bigint, links bigint, root bigint"))
    links = pinned(found.groupBy("node").agg(F.sum("links").alias("links")))
    named = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classes = distinct.select("label", "vector", "node", "copies").join(links, "node", "left").join(named, "node", "left")
    classes = pinned(
        classes.select(
            "label",
            "vector",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
            F.coalesce("component", "node").alias("class"),
        )
    )
    return rows.join(classes, ["label", "vector"], "left").select(
        F.col("node").alias(id_column),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class", "node").alias("component_id"),
        F.coalesce("class", "node").eqNullSafe(F.col("node")).alias("kept"),
    )
