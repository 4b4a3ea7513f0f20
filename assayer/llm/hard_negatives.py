"""Hard negatives of anchors, by length buckets with sorted coordinate lists.

The positives of an anchor are its best other rows with its label; its hard negatives for a positive are the best rows with
another label whose score lies in a stated band below that of the positive. A score is an inner product of integer vectors.

**Buckets.** Rows are sorted by label and length (Euclidean norm) and cut into buckets of up to ``BUCKET`` rows of one label
and of similar length, longest first. A bucket holds, for every coordinate, its rows sorted by that coordinate of the vector
scaled to length one.

**Pruning.** Let t be the lowest score that an anchor q can still use: the lower end of a band, or the last of a full list.
In a bucket with longest row l, a row v with q . v >= t has a cosine of at least c = t / (|q| l). If c > 1 the bucket is
skipped. Else each coordinate f of v / |v| lies within c q_f ± sqrt((1 - c^2)(1 - q_f^2)), with q scaled to length one (without an upper end where
q_f > c, without a lower one where q_f < -c): a range of the sorted list of f. The ranges of the ``FOCUS`` largest coordinates of the anchor are intersected, and what is in all of
them is verified by its exact score. Ranges are widened by ``SLACK``, so rounding loses nothing.

**At scale.** Anchors are dealt into blocks, of one label while positives are searched. A unit of work is one block of anchors with a strip of buckets, met
one after the other, so that a list filled early prunes what follows. Positives meet the buckets of their label only,
negatives those of the others. A unit returns no more rows than its anchors can use. As every anchor is held against all
rows in the worst case, work grows with anchors times rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.llm.common import narrow
from assayer.llm.components import runs
from assayer.llm.int_vectors import LARGEST, dealt, matrix, numbered, products, rows_of, scaled, unpacked
from assayer.session import pinned

BUCKET = 4096
ANCHORS = 128
STRIP = 8
FOCUS = 4
SLACK = 1e-9
COMPONENTS = 1 << 20  # components of a bucket at most, for very long vectors
WORTH = 0.6  # a range with more of the bucket than this rules out too little to be followed
_LOW = -(1 << 62)
_HIGH = 1 << 62
_UNIT = ["group", "part", "strip"]


def _buckets(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Packed buckets of consecutive rows of one length and label, with the order of their rows by every coordinate."""
    for rows in runs(batches, ["size", "label"]):
        size, label = rows["size"][0].as_py(), rows["label"][0].as_py()
        most = max(1, min(BUCKET, COMPONENTS // max(1, size)))
        for start in range(0, rows.num_rows, most):
            part = rows.slice(start, most)
            node, ids = (part[c].to_numpy().astype("<i8") for c in ("node", "vec_id"))
            values = matrix(part["vector"], size)
            order = np.argsort(_units(values)[0], axis=0, kind="stable").T.astype("<u2")
            packed = [x.tobytes() for x in (node, ids, np.ascontiguousarray(values), np.ascontiguousarray(order))]
            yield pa.RecordBatch.from_pydict(
                dict(zip(names, ([x] for x in (size, label, int(node[0]), *packed)), strict=True)), pa.schema(_bucket_fields(names))
            )


def _bucket_fields(names: list[str]) -> list[tuple]:
    return list(zip(names, [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4], strict=True))


def _units(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one (zeros stay), and their lengths."""
    lengths = np.sqrt((values.astype(np.float64) ** 2).sum(axis=1))
    return values / np.where(lengths == 0, 1, lengths)[:, None], lengths


class Bucket:
    """Rows of similar length with a sorted list for each coordinate."""

    def __init__(self, row: dict):
        self.nodes, self.ids = (np.frombuffer(row[c], dtype="<i8") for c in ("node", "ids"))
        self.values = unpacked(row["matrix"], len(self.nodes))
        unit, lengths = _units(self.values)
        self.longest = float(lengths.max())
        self.order = np.frombuffer(row["sorted"], dtype="<u2").reshape(-1, len(self.nodes))
        self.sorted = np.take_along_axis(unit.T, self.order.astype(np.int64), axis=1)

    def candidates(self, unit: np.ndarray, length: float, least: int) -> np.ndarray | None:
        """The rows that can reach a score of ``least`` with an anchor of this direction and length; None: all of them."""
        if least <= 0 or not len(unit):
            return None
        reach = length * self.longest
        if least > reach * (1 + SLACK):
            return np.zeros(0, dtype=np.int64)
        cosine = min(1.0, least / reach) * (1 - SLACK)
        ranges = []
        for f in np.argsort(-np.abs(unit))[:FOCUS]:
            middle, half = cosine * unit[f], np.sqrt(max(0.0, (1 - cosine**2) * (1 - unit[f] ** 2))) + SLACK
            # the range has no end on the side where an axis itself is near enough to the anchor
            edges = (-2.0 if unit[f] < -cosine else middle - half), (2.0 if unit[f] > cosine else middle + half)
            low, high = np.searchsorted(self.sorted[f], edges)
            ranges.append((high - low, f, low, high))
        ranges = [r for r in sorted(ranges) if r[0] < WORTH * len(self.nodes)]
        if not ranges:
            return None
        held = np.zeros(len(self.nodes), dtype=np.int8)
        for _, f, low, high in ranges:
            held[self.order[f, low:high]] += 1
        return np.flatnonzero(held == len(ranges))


class Wanted:
    """The best rows so far of one anchor and band: highest scores, then smallest ids."""

    __slots__ = ("low", "high", "limit", "scores", "ids", "nodes")

    def __init__(self, low: int, high: int, limit: int):
        self.low, self.high, self.limit = low, high, limit
        self.scores = self.ids = self.nodes = np.zeros(0, dtype=np.int64)

    def least(self) -> int:
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.limit else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray, nodes: np.ndarray) -> None:
        keep = np.flatnonzero((scores >= self.least()) & (scores <= self.high))
        if len(keep):
            scores, ids, nodes = (np.append(old, new[keep]) for old, new in ((self.scores, scores), (self.ids, ids), (self.nodes, nodes)))
            order = np.lexsort((nodes, ids, -scores))[: self.limit]
            self.scores, self.ids, self.nodes = scores[order], ids[order], nodes[order]


class Anchor:
    """An anchor with its direction and length, and what it looks for."""

    __slots__ = ("node", "label", "vector", "unit", "length", "bands", "wanted")

    def __init__(self, row: dict, limit: int):
        vector, bands = row["vector"], row["bands"]
        self.node, self.label = row["first"], row["label"]
        self.vector = np.array(vector, dtype=np.float64 if _small(vector) else np.int64)
        units, lengths = _units(self.vector[None, :])
        self.unit, self.length = units[0], float(lengths[0])
        self.bands = [b["band"] for b in bands]
        self.wanted = [Wanted(b["low"], b["high"], limit) for b in bands]

    def meet(self, bucket: Bucket) -> None:
        least = min((w.least() for w in self.wanted), default=_HIGH)
        some = bucket.candidates(self.unit, self.length, least)
        if some is None:
            values, ids, nodes = bucket.values, bucket.ids, bucket.nodes
        else:
            values, ids, nodes = bucket.values[some], bucket.ids[some], bucket.nodes[some]
        if len(nodes):
            scores, other = products(values, self.vector), nodes != self.node
            for wanted in self.wanted:
                wanted.add(scores[other], ids[other], nodes[other])


def _small(vector: list[int]) -> bool:
    return len(vector) * max(map(abs, vector), default=0) * LARGEST < 1 << 53


def _searched(batches: Iterator[pa.RecordBatch], same: bool, limit: int) -> Iterator[pa.RecordBatch]:
    """The best rows of each anchor and band in a strip. The anchors of a unit come before its buckets."""
    key, anchors = None, []

    def found() -> pa.RecordBatch:
        rows = [(a.node, b, w.nodes, w.ids, w.scores) for a in anchors for b, w in zip(a.bands, a.wanted, strict=True) if len(w.ids)]
        times = [len(r[2]) for r in rows]
        columns = [np.repeat([r[k] for r in rows], times) if k < 2 else np.concatenate([r[k] for r in rows] or [[]]) for k in range(5)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "band", "node", "vec_id", "score"])

    for row in rows_of(batches):
        now = tuple(row[k] for k in _UNIT)
        if now != key:
            if anchors:
                yield found()
            key, anchors = now, []
        if row["sorted"] is None:
            anchors.append(Anchor(row, limit))
        elif anchors:
            bucket = Bucket(row)
            for anchor in anchors:
                if same == (anchor.label == row["label"]):
                    anchor.meet(bucket)
    if anchors:
        yield found()


def _best(anchors: DataFrame, buckets: DataFrame, same: bool, limit: int) -> DataFrame:
    """(anchor, band, node, vec_id, score, place) of the best rows for stored anchors (node, size, label, vector, bands).

    ``same``: rows with the label of the anchor, else those with another one.
    """
    shared = ["size", "label"] if same else ["size"]
    groups = anchors.groupBy(*shared).agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("parts"))
    sizes = buckets.groupBy(*shared).agg(F.ceil(F.count(F.lit(1)) / STRIP).cast("int").alias("strips"))
    groups = pinned(numbered(groups.join(sizes, shared), "group"))
    units = groups.agg(F.sum(F.col("strips") * F.col("parts")).alias("n")).first()["n"] or 1
    packed, own = ["node", "ids", "matrix", "sorted"], ["vector", "bands"]
    met = buckets.join(narrow(groups), shared)
    met = met.withColumns({"strip": _dealt("first", "strips"), "kind": F.lit(1)}).withColumn("part", _each("parts"))
    none = [F.lit(None).cast(t).alias(c) for c, t in zip(own, ("array<int>", _BANDS), strict=True)]
    met = met.select(*_UNIT, "kind", "first", "label", *packed, *none)
    given = anchors.withColumnRenamed("node", "first").join(narrow(groups), shared)
    given = given.withColumns({"part": _dealt("first", "parts"), "kind": F.lit(0)}).withColumn("strip", _each("strips"))
    none = [F.lit(None).cast("binary").alias(c) for c in packed]
    given = given.select(*_UNIT, "kind", "first", "label", *none, *own)
    rows = dealt(given.union(met), _UNIT, ["kind", "first"], units)
    schema = "anchor bigint, band bigint, node bigint, vec_id bigint, score bigint"
    found = rows.mapInArrow(lambda batches: _searched(batches, same, limit), schema)
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "vec_id", "node")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)


def _dealt(name: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(name), F.col(parts)).cast("int")


def _each(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


_BANDS = "array<struct<band:bigint,low:bigint,high:bigint>>"


def mined(
    embeddings: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    band: tuple[int, int] = (30, 90),
    scale: int = 256,
    label: Column | None = None,
    id_column="vec_id",
    vector_column="embedding",
    label_column="label",
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on ``vec_id``. A component x becomes floor(``scale`` * x), x as double; scores are inner
    products of these integers, and equal scores go to smaller ids. An anchor's positives are its first ``positives`` other
    rows of the same label. For each of them the first ``negatives`` rows of other labels are returned whose score in
    hundredths lies in ``band`` times the positive's score; all where there are fewer, none where the band is empty (as for
    a negative score). ``label`` replaces the label by an expression of ``vec_id`` and ``label``.

    Rows without an id or a label, and vectors that are null or hold a null, NaN or infinite component take no part; nor do
    rows whose label becomes null. Only vectors of equal length meet; zero vectors score 0 with all. Scaled components are
    held within 2**24 of zero. Rows that repeat an id are rows of their own, as anchors too. Without anchors, or on an empty
    table, there are no rows.
    """
    rows = scaled(embeddings, scale, id_column, vector_column, label=label_column).where("label IS NOT NULL")
    rows = rows.withColumn("label", (F.col("label") if label is None else label).cast("bigint")).where("label IS NOT NULL")
    rows = rows.withColumn("size", F.size("vector"))
    length = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    order = ["size", "label", F.desc("norm"), "vec_id"]
    rows = pinned(numbered(rows.withColumn("norm", length).orderBy(*order), "node").drop("norm"))
    names = ["size", "label", "first", "node", "ids", "matrix", "sorted"]
    schema = "size int, label bigint, first bigint, node binary, ids binary, matrix binary, sorted binary"
    sorted_rows = rows.select("size", "label", "node", "vec_id", "vector")
    buckets = pinned(sorted_rows.mapInArrow(lambda batches: _buckets(batches, names), schema))
    chosen = rows.where(F.coalesce(anchors, F.lit(False)))
    all_bands = F.array(F.struct(F.lit(0).cast("bigint").alias("band"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high")))
    given = pinned(chosen.withColumn("bands", all_bands.cast(_BANDS)))
    near = pinned(_best(given, buckets, True, positives))
    low, high = (F.lit(b) * F.col("score") for b in band)
    limits = near.withColumns({"least": -low, "most": high}).select(
        "anchor",
        F.struct(
            F.col("place").cast("bigint").alias("band"), (-_hundredth("least")).alias("low"), _hundredth("most").alias("high")
        ).alias("one"),
    )
    limits = limits.where("one.low <= one.high")
    limits = limits.groupBy("anchor").agg(F.collect_list("one").cast(_BANDS).alias("bands"))
    given = pinned(given.drop("bands").join(limits.withColumnRenamed("anchor", "node"), "node"))
    far = _best(given, buckets, False, negatives).select(
        "anchor", "band", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    near = near.select(
        "anchor", F.col("place").cast("bigint").alias("band"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    named = given.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    result = far.join(near, ["anchor", "band"]).join(named, "anchor")
    return result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _hundredth(name: str) -> Column:
    """floor(value / 100) of a column of whole numbers, in whole numbers."""
    return F.expr(f"({name} - pmod({name}, 100)) div 100")
