"""Exact top-k search by inner product, in the three phases of the uniform threshold.

Vectors are cut into ``SLICES`` slices of coordinates. A slice is one node of the search: it knows the local scores of all
vectors, that is their inner products over its own coordinates, and a score is the sum of its local scores.

1. **Lists.** Each slice gives the vectors with its highest local scores for a query. The exact scores of all listed vectors
   are computed, and the k-th of them is a cutoff that is safe: at least k vectors reach it.
2. **Sufficient entries.** The cutoff c of a query goes to all slices. A vector that reaches c has a local score of at least
   c / ``SLICES`` in one slice or more, so each slice returns the vectors at or above that bound with their local scores.
3. **Resolution.** An entry whose known local scores and the bound of the unknown ones stay below c is dropped. The unknown
   local scores of the others are computed, and the k best of them are the result.

**At scale.** Equal vectors are one vector with its smallest ids, of which more than k are never needed; so copies, however
many, cost nothing. Vectors travel as packed blocks of ``BLOCK`` rows and queries as blocks of ``QUERIES``; a unit of work is
one block of queries with a strip of ``STRIP`` blocks of vectors, met one after the other. The first two phases read the
columns of one slice only; the last reads only blocks that have entries. As every query is held against all vectors, work
grows with queries times vectors; what phase 2 returns depends on how far the best scores stand out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import narrow
from assayer.llm.int_vectors import dealt, inner_product, matrix, numbered, products, rows_of, scaled, unpacked
from assayer.session import pinned

SLICES = 2
BLOCK = 4096  # vectors of a block; its numbers fit 16 bits
QUERIES = 1024
STRIP = 8
LISTED = 2  # times k vectors in a local list
COMPONENTS = 1 << 20  # components of a block at most, for very long vectors
_KEYS = ["slice", "size", "part", "strip"]
_LOW = np.iinfo(np.int64).min


def _packed(rows: pa.Table, columns: list[str]) -> pa.Table:
    """One row for a block: its nodes, its matrix cut into slices, and the ``columns`` as packed numbers."""
    size = rows["size"][0].as_py()
    values = matrix(rows["vector"], size)
    slices = np.array_split(np.arange(size), SLICES)
    out = {name: pa.array([rows[name].to_numpy().astype("<i8").tobytes()], pa.binary()) for name in ["node", *columns]}
    out |= {f"s{k}": pa.array([np.ascontiguousarray(values[:, own]).tobytes()], pa.binary()) for k, own in enumerate(slices)}
    return pa.table({"size": rows["size"][:1], "block": rows["block"][:1], **out})


def _blocks(vectors: DataFrame, rows: int, *columns: str) -> tuple[DataFrame, int]:
    """Stored blocks of vectors (node, vector, …), and how many there are of any one size at most."""
    vectors = vectors.withColumn("size", F.size("vector"))
    seen = vectors.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")).first()
    count = max(1, -(-seen["n"] // max(1, min(rows, COMPONENTS // max(1, seen["size"] or 0)))))
    vectors = vectors.withColumn("block", F.pmod(F.xxhash64("node"), F.lit(count)).cast("int"))
    schema = ", ".join(f"{name} binary" for name in ["node", *columns, *(f"s{k}" for k in range(SLICES))])
    blocks = vectors.groupBy("size", "block").applyInArrow(
        lambda group: _packed(group, list(columns)), f"size int, block int, {schema}"
    )
    return pinned(blocks), count


def _units(queries: DataFrame, vectors: DataFrame, parts: int, blocks: int, columns: list[str]) -> DataFrame:
    """Rows of the units (slice, size, part, strip): a block of queries first, then blocks of vectors."""
    strips = -(-blocks // STRIP)
    nothing = [F.lit(None).cast("binary").alias(c) for c in columns]
    given = queries.withColumns({"part": F.col("block"), "strip": F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))})
    given = given.withColumns({"block": F.lit(-1), "kind": F.lit(0)})
    strip = F.floor(F.col("block") / STRIP).cast("int")
    met = vectors.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(parts - 1))), "strip": strip, "kind": F.lit(1)})
    shared = ["slice", "size", "part", "strip", "block", "kind", "node", *[c for c in vectors.columns if c.startswith("s") and c[1:].isdigit()]]
    return given.select(*shared, *columns).union(met.select(*shared, *nothing))


def _slice_units(queries: DataFrame, vectors: DataFrame, parts: int, blocks: int, columns: list[str], run, schema: str) -> DataFrame:
    """Runs ``run`` on the units of every slice; each reads the columns of its slice alone."""
    found = None
    for k in range(SLICES):
        one = [F.lit(k).alias("slice"), "size", "block", "node", F.col(f"s{k}").alias("s0")]
        units = _units(queries.select(*one, *columns), vectors.select(*one), parts, blocks, columns)
        found = units if found is None else found.union(units)
    units = dealt(found, _KEYS, ["block"], SLICES * parts * -(-blocks // STRIP))
    return units.mapInArrow(run, schema)


class _Best:
    """The best nodes of each query of a block: highest scores, then smallest nodes."""

    def __init__(self, queries: int, limit: int):
        self.limit = limit
        self.scores = np.full((queries, limit), _LOW, dtype=np.int64)
        self.nodes = np.full((queries, limit), -1, dtype=np.int64)

    def add(self, row: int, scores: np.ndarray, nodes: np.ndarray) -> None:
        if len(scores) > self.limit:
            last = np.partition(scores, len(scores) - self.limit)[len(scores) - self.limit]
            keep = scores >= max(last, self.scores[row, -1])
            scores, nodes = scores[keep], nodes[keep]
        scores, nodes = np.append(self.scores[row], scores), np.append(self.nodes[row], nodes)
        order = np.lexsort((nodes, -np.maximum(scores, _LOW + 1)))[: self.limit]
        self.scores[row], self.nodes[row] = scores[order], nodes[order]

    def rows(self, queries: np.ndarray, **more: pa.Array) -> pa.RecordBatch:
        at, place = np.nonzero(self.nodes >= 0)
        found = {"query": queries[at], "node": self.nodes[at, place], "score": self.scores[at, place]}
        columns = {k: pa.array(v, pa.int64()) for k, v in found.items()}
        columns |= {k: pa.array(np.full(len(at), v), pa.int32()) for k, v in more.items()}
        return pa.RecordBatch.from_pydict(columns)


def _lists(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Phase 1: the highest local scores of each query in a strip."""
    key = queries = best = None
    for row in rows_of(batches):
        now = tuple(row[k] for k in _KEYS)
        if now != key:
            if best:
                yield best.rows(queries, slice=key[0])
            key, best = now, None
        nodes = np.frombuffer(row["node"], dtype="<i8")
        if row["kind"] == 0:
            queries, asked, best = nodes, unpacked(row["s0"], len(nodes)), _Best(len(nodes), limit)
        elif best:
            values = unpacked(row["s0"], len(nodes))
            for i in range(len(queries)):
                best.add(i, products(values, asked[i]), nodes)
    if best:
        yield best.rows(queries, slice=key[0])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 2: places and local scores of what reaches a query's cutoff over the number of slices."""
    key = asked = None
    for row in rows_of(batches):
        now, count = tuple(row[k] for k in _KEYS), len(row["node"]) // 8
        if row["kind"] == 0:
            key, asked, cutoff = now, unpacked(row["s0"], count), np.frombuffer(row["cutoff"], dtype="<i8")
        elif now == key:
            local = products(asked, unpacked(row["s0"], count))
            query, vector = np.nonzero(local >= -(-cutoff // SLICES)[:, None])
            if len(query):
                packed = [query.astype("<u2"), vector.astype("<u2"), local[query, vector].astype("<i8")]
                values = {k: row[k] for k in [*_KEYS, "block"]} | dict(zip("abc", (p.tobytes() for p in packed), strict=True))
                yield pa.RecordBatch.from_pylist([values], _ENTRY)


_ENTRY = pa.schema([*((k, pa.int32()) for k in [*_KEYS, "block"]), *((k, pa.binary()) for k in "abc")])


def _resolved(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Phase 3: exact scores of the entries that can reach the cutoff, and the best of them in a strip."""
    key = best = None
    entries: dict[int, tuple] = {}

    def resolve() -> None:
        codes = np.unique(np.concatenate([e[0] for e in entries.values()]))
        query, vector = np.divmod(codes, len(nodes))
        known, unknown = np.zeros(len(codes), dtype=np.int64), np.zeros((len(codes), SLICES), dtype=bool)
        for k in range(SLICES):
            own, local = entries.get(k, (np.zeros(0, dtype=np.int64),) * 2)
            at = np.searchsorted(codes, own)
            known[at] += local
            unknown[:, k] = True
            unknown[at, k] = False
        most = known + unknown.sum(axis=1) * ((cutoff[query] - 1) // SLICES)
        keep = most >= cutoff[query]
        query, vector, total, unknown = query[keep], vector[keep], known[keep], unknown[keep]
        for k in range(SLICES):
            at = np.flatnonzero(unknown[:, k])
            for some in np.array_split(at, len(at) // 100_000 + 1):
                a, b = asked[k][query[some]], values[k][vector[some]]
                total[some] += np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
        keep = total >= cutoff[query]
        query, vector, total = query[keep], vector[keep], total[keep]
        begins = np.searchsorted(query, np.arange(len(queries) + 1))
        for i in np.unique(query):
            own = slice(begins[i], begins[i + 1])
            best.add(i, total[own], nodes[vector[own]])

    for row in rows_of(batches):
        now = tuple(row[k] for k in _KEYS)
        if entries and (now != key or row["kind"] < 2):
            resolve()
            entries = {}
        if now != key:
            if best:
                yield best.rows(queries)
            key, best = now, None
        if row["kind"] == 0:
            queries, cutoff = (np.frombuffer(row[k], dtype="<i8") for k in ("node", "cutoff"))
            asked, best = [unpacked(row[f"s{k}"], len(queries)) for k in range(SLICES)], _Best(len(queries), limit)
        elif row["kind"] == 1:
            nodes = np.frombuffer(row["node"], dtype="<i8")
            values = [unpacked(row[f"s{k}"], len(nodes)) for k in range(SLICES)]
        else:
            query, vector = (np.frombuffer(row[k], dtype="<u2").astype(np.int64) for k in "ab")
            entries[row["kind"] - 2] = query * len(nodes) + vector, np.frombuffer(row["c"], dtype="<i8")
    if entries:
        resolve()
    if best:
        yield best.rows(queries)


def _first(rows: DataFrame, group: list[str], order: list, limit: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("place", place).where(F.col("place") <= limit)


def searched(vectors: DataFrame, limit: int) -> DataFrame:
    """(query, node, score): for each vector with ``asked``, the ``limit`` vectors with the highest scores, itself included.

    ``vectors`` is a stored table (node, vector, asked) of different vectors. Equal scores go to smaller nodes. Only vectors
    of equal length have a score.
    """
    asked = vectors.where("asked").select("node", "vector")
    found, blocks = _blocks(vectors.select("node", "vector"), BLOCK)
    given, parts = _blocks(asked, QUERIES)
    listed = LISTED * limit
    schema = "query bigint, node bigint, score bigint, slice int"
    lists = _slice_units(given, found, parts, blocks, [], lambda batches: _lists(batches, listed), schema)
    lists = _first(lists, ["query", "slice"], [F.desc("score"), "node"], listed).select("query", "node").distinct()
    pairs = pinned(lists).join(vectors.select("node", "vector"), "node")
    pairs = pairs.join(asked.toDF("query", "other"), "query").select("query", inner_product("vector", "other").alias("score"))
    cutoffs = _first(pairs, ["query"], [F.desc("score")], limit).groupBy("query")
    # a query that meets fewer vectors than asked for needs all of them
    least = F.when(F.count(F.lit(1)) == limit, F.min("score")).otherwise(F.lit(-(1 << 62)))
    cutoffs = pinned(cutoffs.agg(least.alias("cutoff"))).withColumnRenamed("query", "node")
    given, parts = _blocks(pinned(asked.join(cutoffs, "node")), QUERIES, "cutoff")
    schema = ", ".join(f"{f.name} {'binary' if f.name in 'abc' else 'int'}" for f in _ENTRY)
    entries = pinned(_slice_units(given, found, parts, blocks, ["cutoff"], _entries, schema))
    columns = ["cutoff", "a", "b", "c"]
    given = given.select(F.lit(0).alias("slice"), "*", *[F.lit(None).cast("binary").alias(c) for c in "abc"])
    units = _units(given, found.select(F.lit(0).alias("slice"), "*"), parts, blocks, columns)
    used = pinned(entries.select("size", "part", "block").distinct())
    used = narrow(used.union(used.select("size", "part", F.lit(-1)).distinct()))
    units = units.join(used, ["size", "part", "block"], "left_semi")
    empty = {c: F.lit(None).cast("binary") for c in ("node", "cutoff", *(f"s{k}" for k in range(SLICES)))}
    more = entries.withColumns({"kind": F.col("slice") + 2, "slice": F.lit(0), **empty})
    units = dealt(units.unionByName(more), _KEYS, ["block", "kind"], parts * -(-blocks // STRIP))
    best = units.mapInArrow(lambda batches: _resolved(batches, limit), "query bigint, node bigint, score bigint")
    return _first(best, ["query"], [F.desc("score"), "node"], limit).drop("place")


def top_k(
    embeddings: DataFrame, queries: Column, k: int = 20, scale: int = 64, id_column="vec_id", vector_column="embedding"
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each query its ``k`` best other rows, or all where there are fewer.

    ``queries`` is a condition on ``vec_id``; null counts as false. A component x becomes floor(``scale`` * x), x as double;
    a score is the inner product of these integers, and equal scores go to smaller ids. Rows without an id and vectors that
    are null or hold a null, NaN or infinite component take no part. Only vectors of equal length meet; empty ones score 0.
    Scaled components are held within 2**24 of zero. A row that repeats an id is a row of its own: it is a candidate for
    the others, and a query with a list of its own. Without queries, or on an empty table, there are no rows.
    """
    rows = scaled(embeddings, scale, id_column, vector_column).withColumn("asked", F.coalesce(queries, F.lit(False)))
    limit = k + 1  # a query finds itself
    groups = rows.groupBy("vector").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.max("asked").alias("asked")
    )
    vectors = pinned(numbered(groups.orderBy("first"), "node"))
    best = pinned(searched(vectors.select("node", "vector", "asked"), limit))
    # the ids of the vectors found; of equal vectors only the smallest can be needed
    found = narrow(pinned(best.select("node").distinct()))
    single = vectors.where("copies = 1").join(found, "node").select("node", F.col("first").alias("vec_id"))
    hot = vectors.where("copies > 1").join(found, "node").select("node", "vector")
    several = _first(rows.select("vec_id", "vector").join(hot, "vector").select("node", "vec_id"), ["node"], ["vec_id"], limit)
    ids = single.union(several.select("node", "vec_id"))
    asked = numbered(rows.where("asked").select("vec_id", "vector"), "row")
    asked = asked.join(vectors.where("asked").select("vector", "node"), "vector")
    asked = pinned(asked.select("row", F.col("vec_id").alias("query_id"), F.col("node").alias("query")))
    lists = asked.join(best, "query").join(pinned(ids), "node")
    own = (F.col("query") == F.col("node")) & (F.col("query_id") == F.col("vec_id"))
    # of the query's own id with its own vector one row is the query itself
    itself = F.when(own, F.row_number().over(Window.partitionBy("row", "node", "vec_id").orderBy("score")))
    lists = lists.withColumn("itself", itself).where("itself IS NULL OR itself > 1")
    result = _first(lists, ["row"], [F.desc("score"), "vec_id"], k)
    return result.select("query_id", F.col("place").alias("rank"), "vec_id", "score")
