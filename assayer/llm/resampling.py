"""Importance resampling towards a target distribution, by hashed word n-grams.

**Words.** A pre-tokenizer of the ``tokenizers`` library, a Split by a regular expression that is not trained, takes the text
with A-Z in lower case and gives its words with their offsets. The n-grams of n words are windows over the list of offset
pairs; the words that the offsets cut out are joined by one space.

**Gains.** The crc32 of a feature modulo ``buckets`` is its bucket. With S features of the documents, s of them in a bucket, and
T and t of the target, the gain of the bucket is floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for B buckets. The weight
of a document is the floored mean of the gains of its features.

**Draw.** A hash of the document's id gives Gumbel noise; the largest sums of weight and noise are a draw without replacement
in proportion to exp(weight / 1000).

**At scale.** Texts are cut into words once. Each row keeps two bytes for each feature (four beyond 65,536 buckets), stored with
the id; a task counts its buckets before it passes them on, so the histogram shuffles one row per task. Histogram and gains
have one number per bucket, whatever the data; they alone reach the driver and every task. Ranks come from one range
sort of narrow rows and the row counts of its partitions.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from assayer.llm.common import narrow, picked
from assayer.session import pinned

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KNOWN = 200_000  # words a task remembers,
LONGEST = 64  # of at most so many characters


class Features:
    """Buckets of the n-grams of 1 to ``width`` words of a text."""

    def __init__(self, width: int, buckets: int):
        self.width, self.buckets = width, buckets
        self.split = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.known: dict[str, int] = {}
        self.kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """How many words the text has, and the bucket of each of its n-grams."""
        lowered = text.encode().lower().decode()
        pieces = self.split.pre_tokenize_str(lowered)
        found = [self._bucket(word) for word, _ in pieces]
        offsets = [pair for _, pair in pieces]
        for width in range(2, self.width + 1):
            # the pairs of offsets of each window
            for window in zip(*(offsets[k:] for k in range(width)), strict=False):
                found.append(zlib.crc32(" ".join(lowered[a:b] for a, b in window).encode()) % self.buckets)
        return len(pieces), np.array(found, dtype=self.kind)

    def _bucket(self, word: str) -> int:
        bucket = self.known.get(word)
        if bucket is None:
            bucket = zlib.crc32(word.encode()) % self.buckets
            if len(word) <= LONGEST:
                if len(self.known) >= KNOWN:
                    self.known.clear()
                self.known[word] = bucket
        return bucket


def _bucketed(batches: Iterator[pa.RecordBatch], width: int, buckets: int) -> Iterator[pa.RecordBatch]:
    features = Features(width, buckets)
    for batch in batches:
        words, rows = [], []
        for text in batch.column("text"):
            count, found = features.of(text.as_py() or "")
            words.append(count)
            rows.append(found.tobytes())
        columns = [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(rows, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "features"])


def _counted(batches: Iterator[pa.RecordBatch], kind: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """The counts of all buckets in a task."""
    total = np.zeros(buckets, dtype=np.int64)
    for batch in batches:
        for row in batch.column("features"):
            total += np.bincount(np.frombuffer(row.as_buffer(), dtype=kind), minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])


def _weighed(batches: Iterator[pa.RecordBatch], kind: str, gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, weights = [], []
        for row in batch.column("features"):
            found = np.frombuffer(row.as_buffer(), dtype=kind)
            counts.append(len(found))
            weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
        columns = [batch.column("doc_id"), batch.column("n_words"), pa.array(counts, pa.int64()), pa.array(weights, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has; ``features`` is a stored table."""
    kind = Features(1, buckets).kind
    counts = features.select("features").mapInArrow(lambda batches: _counted(batches, kind, buckets), "bucket bigint, n bigint")
    found = np.zeros(buckets, dtype=np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket at most
        found[row["bucket"]] = row["n"]
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, from its counts in the documents and in the target."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    found = [math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets)))) for s, t in pairs]
    return np.array(found, dtype=np.int64)


def noise(identifier: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))) for u in (0, 1) from the SHA-256 of ``seed:id``; a null id counts as an empty one."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(
    documents: DataFrame,
    target: DataFrame,
    width: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
    id_column="doc_id",
    text_column="text",
    target_column="text",
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (1, 2, … of the documents drawn; null for the others).

    Of the N documents with at least ``least_words`` words, floor(``percent`` N / 100) are drawn: those with the highest
    scores, ties to the smaller id; rows with one id and score get their ranks in any order. A document without words has
    weight 0. A null text counts as empty. A null id counts as the empty text in the noise and comes last among ties.
    Without any target text t and T are 0. An empty table gives no rows. Texts of any length are taken whole.
    """
    rows = picked(documents, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, features binary"
    found = pinned(rows.mapInArrow(lambda batches: _bucketed(batches, width, buckets), schema))
    wanted = picked(target, text=target_column).select(F.lit(0).alias("doc_id"), "text")
    wanted = wanted.mapInArrow(lambda batches: _bucketed(batches, width, buckets), "doc_id int, n_words bigint, features binary")
    gained = gains(histogram(found, buckets), histogram(wanted, buckets))
    packed = Features(1, buckets).kind
    schema = f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    weighed = found.mapInArrow(lambda batches: _weighed(batches, packed, gained), schema)
    weighed = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    usable = F.col("n_words") >= least_words
    # all documents in the order of the draw, the others after them
    order = [F.desc(usable), F.desc("score"), F.asc_nulls_last("doc_id")]
    placed = weighed.orderBy(*order).withColumn("place", F.monotonically_increasing_id())
    placed = pinned(placed.withColumn("usable", usable).drop("n_words"))
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.count_if("usable").alias("usable"))
    sizes = sorted((r["part"], r["n"], r["usable"]) for r in counts.collect())  # one row for each task of the sort
    drawn = percent * sum(s[2] for s in sizes) // 100
    begins, before = [], 0
    for number, n, _ in sizes:
        begins.append((number, before))
        before += n
    first = documents.sparkSession.createDataFrame(begins or [(0, 0)], "part bigint, before bigint")
    ranked = placed.withColumn("part", part).join(narrow(first), "part")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    rank = F.when(F.col("usable") & (rank <= drawn), rank)
    return ranked.select(F.col("doc_id").alias(id_column), "n_features", "weight", "score", rank.alias("rank"))
