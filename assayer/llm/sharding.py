"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``POINTS`` points on the ring of 64-bit hashes. A key belongs to the arc that ends at the next point
clockwise. No shard takes more rows than its bound; what overflows a full shard continues clockwise, point by point. All keys
of an arc meet the same shards in the same order, so the flow follows from the rows per arc, a table of shards times
``POINTS`` counts. Each row then gets its rank within its arc and looks up the shard and slot of that rank.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import picked, ranked
from assayer.session import pinned

POINTS = 64
CELLS = 4096  # equal parts of the ring, by which a position finds its arc
RING = 1 << 64
FLOW = "arc int, low bigint, high bigint, shard int, slot bigint"


def ring(shards: int) -> list[tuple[int, int]]:
    """(position, shard) of all points, clockwise. Positions depend on shard and number only, so that growth moves none."""

    def place(shard: int, point: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{point}".encode(), digest_size=8).digest(), "little")

    return sorted((place(s, p), s) for s in range(shards) for p in range(POINTS))


def arcs_by_cell(points: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(cell, arc, low, high): the arcs that reach into each cell of the ring; bounds as signed integers, both included."""
    width, half = RING // CELLS, RING // 2
    spans = [(i, lo + 1, hi) for i, ((lo, _), (hi, _)) in enumerate(zip(points, points[1:], strict=False), 1)]
    spans += [(0, points[-1][0] + 1, RING - 1), (0, 0, points[0][0])]
    rows = []
    for arc, low, high in spans:
        for cell in range(low // width, high // width + 1) if low <= high else ():
            rows.append((cell, arc, max(low, cell * width) - half, min(high, (cell + 1) * width - 1) - half))
    return rows


def flow(counts: dict[int, int], points: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Rows (arc, low, high, shard, slot): where ranks low to high - 1 of an arc go, from which slot on."""
    filled, placed = [0] * len(room), dict.fromkeys(counts, 0)
    rows, waiting, step = [], sorted(counts), 0
    while waiting:
        for arc in waiting:
            shard = points[(arc + step) % len(points)][1]
            if many := min(counts[arc] - placed[arc], room[shard] - filled[shard]):
                rows.append((arc, placed[arc], placed[arc] + many, shard, filled[shard]))
                placed[arc] += many
                filled[shard] += many
        waiting, step = [a for a in waiting if placed[a] < counts[a]], step + 1
    return rows


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    """The most rows of each shard: equal shares and ``slack`` on top; without slack the first shards take what is over."""
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def sharded(documents: DataFrame, shards: int, slack: float = 0.0, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Without ``slack`` the row counts of two shards differ by one at most; with it, a shard holds at most that much more than
    an equal share, and fewer rows move when a shard is added. A null text has no bytes and the CRC of an empty one. Rows
    without an id, and rows that repeat one, are placed like any others. Slots count from 0 within each shard.
    """
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    points = ring(shards)
    cells = F.broadcast(spark.createDataFrame(arcs_by_cell(points), "cell int, arc int, low bigint, high bigint"))
    rows = picked(documents, doc_id=id_column, text=text_column).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("doc_id").alias("position"),
    )
    # The sign moves the smallest hash to the start of the ring.
    cell = (F.shiftright("position", 64 - int(math.log2(CELLS))) + CELLS // 2).cast("int")
    placed = rows.withColumn("cell", cell).join(cells, "cell")
    placed = placed.where((F.col("position") >= F.col("low")) & (F.col("position") <= F.col("high")))
    stored = pinned(placed.select("doc_id", "size", "text_crc32", "position", "arc"))
    counts = {r["arc"]: r["n"] for r in stored.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = flow(counts, points, bounds(sum(counts.values()), shards, slack))
    places = F.broadcast(spark.createDataFrame(found, FLOW))
    keys = ["position", "doc_id", "text_crc32", "size"]
    in_order = ranked(stored, "arc", keys, keys)
    return (
        in_order.join(places, "arc")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .select("doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("rank") - F.col("low")).alias("slot"))
    )
