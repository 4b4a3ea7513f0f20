"""Best-fit packing of token sequences: large items are matched, small ones fill the gaps.

Only counts decide where a length goes, so the plan is made from the histogram of lengths, which has at most ``capacity``
rows whatever the number of documents:

1. A length above a third of the capacity shares a sequence with one other such length at most. From the longest down, each
   is matched with the longest that still fits beside it.
2. Smaller lengths, from the longest down, go into the smallest gap that holds them, as often as they fit there, then into
   new sequences.

The plan says for every length which ranks go into which sequences; each piece gets its rank within its length in Spark and
looks its place up.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import picked, ranked
from assayer.llm.ids import fast_encoder
from assayer.session import pinned

END_ID = 0
PLAN = "length int, low bigint, high bigint, sequence bigint, per bigint, at bigint"


def pieces(documents: DataFrame, path: str, capacity: int, id_column="doc_id", text_column="text", keep_ids=False) -> DataFrame:
    """The token pieces of every document: its ids and then ``END_ID``, cut from the end into pieces of ``capacity`` tokens.

    Only documents longer than ``capacity`` are cut, and only their first piece can be shorter. A null text is an empty one,
    which has ``END_ID`` alone. Returns doc_id, piece, start, length, ids_crc32 and, if asked for, the ids themselves as
    little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = fast_encoder(path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            out = defaultdict(list)
            for row, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "") + end
                count = len(ids) // 4
                first = (count - 1) % capacity + 1
                for piece, stop in enumerate(range(first, count + 1, capacity)):
                    start = max(0, stop - capacity)
                    cut = ids[4 * start : 4 * stop]
                    out["row"].append(row)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["crc"].append(zlib.crc32(cut))
                    if keep_ids:
                        out["ids"].append(cut)
            arrays = [batch.column("doc_id").take(pa.array(out["row"], pa.int64()))]
            arrays += [pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64())]
            arrays += [pa.array(out["length"], pa.int32()), pa.array(out["crc"], pa.int64())]
            arrays += [pa.array(out["ids"], pa.binary())] if keep_ids else []
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = picked(documents, doc_id=id_column, text=text_column)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length int, ids_crc32 bigint" + ", ids binary" * keep_ids
    return rows.mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: rows (length, low, high, sequence, per, at).

    Ranks low to high - 1 of a length go to the sequences from ``sequence`` on, ``per`` into each, from position ``at``.
    """
    bins: list[tuple[int, int, list[tuple[int, int]]]] = []  # how many alike, their gap, (length, how often) in each
    left = dict(counts)
    large = sorted(n for n in counts if 3 * n > capacity)
    for a in reversed(large):
        for b in reversed(large[: bisect.bisect_right(large, min(a, capacity - a))]):
            if many := left[a] // 2 if a == b else min(left[a], left[b]):
                bins.append((many, capacity - a - b, [(a, 2)] if a == b else [(a, 1), (b, 1)]))
                left[a] -= many
                left[b] -= many
            if not left[a]:
                break
        if left[a]:
            bins.append((left[a], capacity - a, [(a, 1)]))
            left[a] = 0
    open_bins: dict[int, list[tuple[int, list[tuple[int, int]]]]] = defaultdict(list)
    gaps: list[int] = []
    closed: list[tuple[int, list[tuple[int, int]]]] = []

    def put(many: int, gap: int, held: list[tuple[int, int]]) -> None:
        if gap == 0:
            closed.append((many, held))
            return
        if not open_bins[gap]:
            bisect.insort(gaps, gap)
        open_bins[gap].append((many, held))

    for many, gap, held in bins:
        put(many, gap, held)
    for n in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        rest = counts[n]
        while rest:
            if (i := bisect.bisect_left(gaps, n)) == len(gaps):
                fit = capacity // n
                if rest >= fit:
                    put(rest // fit, capacity - fit * n, [(n, fit)])
                if rest % fit:
                    put(1, capacity - rest % fit * n, [(n, rest % fit)])
                break
            gap = gaps[i]
            many, held = open_bins[gap].pop()
            if not open_bins[gap]:
                gaps.pop(i)
            fit = min(gap // n, rest)
            used = min(many, rest // fit)
            if many > used:
                put(many - used, gap, held)
            put(used, gap - fit * n, [*held, (n, fit)])
            rest -= used * fit
    rows, sequence, rank = [], 0, defaultdict(int)
    for many, held in [*closed, *((m, h) for gap in gaps for m, h in open_bins[gap])]:
        at = 0
        for n, per in held:
            rows.append((n, rank[n], rank[n] + many * per, sequence, per, at))
            rank[n] += many * per
            at += n * per
        sequence += many
    return rows


def packed(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to a stored table with doc_id, piece, ids_crc32 and length (1 to ``capacity``).

    Every row gets a place, repeated rows and rows without an id too; the offsets of a sequence leave no gap. An empty table
    stays empty.
    """
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # At most a few ranges for each of the capacity's lengths, whatever the number of documents.
    places = F.broadcast(spark.createDataFrame(plan(counts, capacity), PLAN))
    rows = ranked(cut, "length", ["doc_id", "piece", "ids_crc32"], ["doc_id", "piece", "ids_crc32"])
    inside = F.col("rank") - F.col("low")
    return (
        rows.join(places, "length")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .withColumn("sequence_id", F.col("sequence") + F.floor(inside / F.col("per")))
        .withColumn("offset", F.col("at") + F.pmod(inside, F.col("per")) * F.col("length"))
        .select(*cut.columns, "sequence_id", "offset")
    )


def best_fit(documents: DataFrame, path: str, capacity: int = 2048, id_column="doc_id", text_column="text") -> DataFrame:
    """Packs all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset. See ``pieces`` and ``packed``."""
    rows = packed(pinned(pieces(documents, path, capacity, id_column, text_column)), capacity)
    return rows.withColumn("length", F.col("length").cast("long"))
