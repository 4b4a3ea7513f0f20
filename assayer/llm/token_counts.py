"""Token counts by a map-side lookup in two tiers, without a shuffle of pre-tokens.

The tokenizer never joins text across white space, so the tokens of a text are those of its pieces between white space. The
first tier is a table of the lengths of the most frequent pieces of all texts. Each task counts its pieces in a bounded
summary, the summaries are merged in a tree of tasks, and at most ``TABLE_ENTRIES`` pieces are broadcast, whatever the size
of the corpus. The second tier is the cache of each worker for all other pieces; what it lacks is encoded by the library.
Only pieces of at most ``LONGEST_PIECE`` characters enter a summary, the table or a cache, so that all of these are bounded in
bytes too; longer ones, such as sentences without blanks, are encoded by the library each time. The tables only save work:
every count is that of the library.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import picked

TABLE_ENTRIES = 32_768
SUMMARY_ENTRIES = 131_072
CACHE_ENTRIES = 600_000
SLICE_CHARS = 4_000_000
LONGEST_PIECE = 64  # characters, at most 256 bytes
FAN_IN = 16  # summaries that one task merges
# str.split() also splits at these; the tokenizer takes them for letters or marks.
_NOT_WHITE = re.compile("[\x1c-\x1f]")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """The library's tokenizer: one thread, no truncation, no padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def lengths(path: str, pieces: list[str]) -> list[int]:
    return [len(e.ids) for e in tokenizer(path).encode_batch_fast(pieces, add_special_tokens=False)]


def _short(pieces: list[str]) -> list[str]:
    """The pieces that a table may hold."""
    if len(max(pieces, key=len, default="")) <= LONGEST_PIECE:
        return pieces
    return [p for p in pieces if len(p) <= LONGEST_PIECE]


def _shrunk(counts: Counter, entries: int) -> Counter:
    """The most frequent entries; ties by the piece itself."""
    if len(counts) <= entries:
        return counts
    return Counter(dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:entries]))


def frequent(documents: DataFrame, entries: int = TABLE_ENTRIES) -> list[str]:
    """About the most frequent pieces of all texts, at most ``entries``. Summaries of tasks are merged in a tree."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        kept = _shrunk(counts, entries)
        arrays = [pa.array([list(kept)], pa.list_(pa.string())), pa.array([list(kept.values())], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["piece", "n"])

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(_short((text.as_py() or "").split()))
                if len(counts) > 2 * SUMMARY_ENTRIES:
                    counts = _shrunk(counts, SUMMARY_ENTRIES)
        yield batch_of(counts)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for row in batch.to_pylist():
                for piece, n in zip(row["piece"], row["n"], strict=True):
                    counts[piece] += n
                counts = _shrunk(counts, SUMMARY_ENTRIES)
        yield batch_of(counts)

    schema = "piece array<string>, n array<bigint>"
    parts = documents.rdd.getNumPartitions()
    rows = documents.mapInArrow(summary, schema)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        rows = rows.repartition(parts).mapInArrow(merged, schema)
    return sorted({piece for row in rows.collect() for piece in row["piece"]})


def counted(documents: DataFrame, path: str, limit: int = 2048, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Whole texts are counted. A null text counts as empty, with no bytes and no tokens; rows without an id and repeated rows
    are counted like any others.
    """
    rows = picked(documents, doc_id=id_column, text=text_column)
    pieces = frequent(rows.select("text"))
    table = dict(zip(pieces, lengths(path, pieces), strict=True))
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, cache = shared.value, worker_cache(path)
        for batch in batches:
            sizes, counts, begin = [], [], 0
            texts = [t or "" for t in batch.column("text").to_pylist()]
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and size < SLICE_CHARS:
                    size += len(texts[end])
                    end += 1
                counts += _counts(texts[begin:end], path, common, cache)
                begin = end
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)


@lru_cache(maxsize=2)
def worker_cache(path: str) -> dict[str, int]:
    """The second tier: lengths of pieces that this worker has met and the table lacks."""
    return {}


def _counts(texts: list[str], path: str, common: dict[str, int], cache: dict[str, int]) -> list[int]:
    parts = [[t] if _NOT_WHITE.search(t) else t.split() for t in texts]
    if len(cache) > CACHE_ENTRIES:
        cache.clear()
    unknown = {p for part in parts for p in part if p not in common and p not in cache}
    new = _short(list(unknown))
    cache.update(zip(new, lengths(path, new), strict=True))
    if len(new) == len(unknown):
        return [sum([common[p] if p in common else cache[p] for p in part]) for part in parts]
    rest = [p for p in unknown if len(p) > LONGEST_PIECE]
    once = dict(zip(rest, lengths(path, rest), strict=True))
    return [sum([common[p] if p in common else once[p] if p in once else cache[p] for p in part]) for part in parts]
