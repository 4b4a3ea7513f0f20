"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors, all hashed into one table: one for every word, one for each of its character
n-grams, one for every pair of neighbouring words, and one for the end. A softmax over two classes stands on top. Vectors and
output weights are trained together by stochastic gradient descent in numpy, on a bounded sample of the labelled documents
(``SAMPLE_ROWS``): half of it of each label, those whose hashed id is smallest, filled up from the other label where one has
fewer. One task gets the sample, as feature counts, and learns from it; only what it has learned, one number a feature, reaches
the driver. The logit is moved by the shares that the labels have among all labelled documents, so a balanced sample doesn't
make the rare label likelier than it is.

The output is linear in the average, so a feature's part in the score is one number. Workers keep the sum of these numbers
for the words they have met.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import picked

SAMPLE_ROWS = 2_500
BUCKETS_LOG2 = 16
BUCKETS = 1 << BUCKETS_LOG2
END, FEATURES = BUCKETS, BUCKETS + 1
DIMENSIONS = 16
EPOCHS = 4
RATE = 0.5
SHORTEST, LONGEST = 3, 5  # character n-grams
CACHE_ENTRIES = 600_000
LONGEST_WORD = 64  # a longer run of characters is taken in stretches of this length
_PRIME = np.uint64(0x100000001B3)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _SPREAD) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, feature) for the word and the character n-grams of each of the words, in < and >, and word hashes."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    word = np.repeat(np.arange(len(words)), sizes)
    begins = np.cumsum(sizes) - sizes
    rest = np.repeat(begins + sizes, sizes) - np.arange(len(codes))  # characters from here to the end of the word
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(sizes.max()), _PRIME))
        whole = np.add.reduceat(codes * powers[np.arange(len(codes)) - begins[word]], begins)
        found = [(np.arange(len(words)), _bucket(whole + np.uint64(1)))]
        hashes = np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, min(LONGEST, len(codes)) + 1):
            hashes[: len(codes) - n + 1] = hashes[: len(codes) - n + 1] * _PRIME + codes[n - 1 :] + np.uint64(n)
            if n >= SHORTEST:
                at = np.flatnonzero(rest >= n)
                found.append((word[at], _bucket(hashes[at])))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), whole


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return hashed(words)[:2]


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """The feature of every two neighbouring words, from the hashes of the words of a text in their order."""
    return _bucket((hashes[:-1] * _PAIR) ^ (hashes[1:] + _PRIME))


def words_of(text: str) -> list[str]:
    words = text.split()
    if len(text) > LONGEST_WORD and max(map(len, words), default=0) > LONGEST_WORD:
        words = [w[i : i + LONGEST_WORD] for w in words for i in range(0, len(w), LONGEST_WORD)]
    return words


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of a text and how often each occurs."""
    words = words_of(text)
    counts = Counter(words)
    number = {w: i for i, w in enumerate(counts)}
    word, feature, hashes = hashed(list(counts))
    often = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))[word]
    pairs = pair_features(hashes[np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))])
    weights = np.concatenate([often, np.ones(len(pairs) + 1)])
    totals = np.bincount(np.concatenate([feature, pairs, [END]]), weights=weights)
    distinct = np.flatnonzero(totals)
    return distinct, totals[distinct]


def trained(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], seed: int = 1) -> np.ndarray:
    """The part of each feature in the logit of label 1. Without both labels there is nothing to learn: all parts are 0."""
    if len(set(labels)) < 2:
        return np.zeros(FEATURES)
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (FEATURES, DIMENSIONS))
    output = np.zeros((DIMENSIONS, 2))
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, counts = bags[i]
            share = counts / counts.sum()
            hidden = share @ vectors[ids]
            logits = hidden @ output
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = output @ p
            output -= rate * np.outer(hidden, p)
            # Scaled so that the step moves the document's own average by the rate, however many features it has.
            vectors[ids] -= rate * np.outer(share / (share @ share), back)
    return vectors @ (output[:, 1] - output[:, 0])


class Scorer:
    """Scores of texts; keeps the sum of parts, the number of features and the hash of each word it has met."""

    def __init__(self, parts: np.ndarray, prior: float = 0.0):
        self.parts, self.prior = parts, prior
        self.known: dict[str, int] = {}
        self.sums, self.sizes, self.hashes = np.zeros(0), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)

    def learn(self, words: set[str]) -> None:
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        new = [w for w in words if w not in self.known]
        if not new:
            return
        begin, end = len(self.known), len(self.known) + len(new)
        if end > len(self.sums):
            self.sums, self.sizes, self.hashes = (np.resize(a, 2 * end) for a in (self.sums, self.sizes, self.hashes))
        word, feature, self.hashes[begin:end] = hashed(new)
        self.sums[begin:end] = np.bincount(word, weights=self.parts[feature], minlength=len(new))
        self.sizes[begin:end] = np.bincount(word, minlength=len(new))
        self.known.update(zip(new, range(begin, end), strict=True))

    def scores(self, texts: pa.Array) -> list[float]:
        found = []
        for text in texts:
            words = words_of(text.as_py() or "")
            self.learn(set(words))
            found.append(self.score(words))
        return found

    def score(self, words: list[str]) -> float:
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        pairs = pair_features(self.hashes[at])
        total = self.sums[at].sum() + self.parts[pairs].sum() + self.parts[END]
        return float(1 / (1 + np.exp(-(total / (self.sizes[at].sum() + len(pairs) + 1) + self.prior))))


def sampled(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[DataFrame | None, float]:
    """(label, place, ids, counts) of at most ``rows`` labelled documents, and the logarithm of the ratio of all labels 1 to 0.

    Half of the rows have each label, in the order of their hashed ids; a label with fewer leaves its places to the other.
    An id that repeats in ``documents`` counts once for each of its labels, by one of its texts. None where a label is missing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [bag(t.as_py() or "") for t in batch.column("text")]
            ids = pa.array([b[0].astype("<i4").tobytes() for b in bags], pa.binary())
            counts = pa.array([b[1].astype("<f4").tobytes() for b in bags], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("place"), ids, counts], names)

    names = ["label", "place", "ids", "counts"]
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").distinct().withColumn("place", F.xxhash64("doc_id"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    if len(sizes) < 2:
        return None, 0.0
    first = min(sizes[0], max(rows // 2, rows - sizes[1]))
    take = {0: first, 1: min(sizes[1], rows - first)}
    chosen = [known.where(F.col("label") == k).orderBy("place", "doc_id").limit(n) for k, n in take.items()]
    found = documents.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("label", "place", "text")
    found = found.mapInArrow(run, "label int, place bigint, ids binary, counts binary")
    found = found.groupBy("label", "place").agg(F.min(F.struct("ids", "counts")).alias("bag"))
    return found.select("label", "place", "bag.ids", "bag.counts"), math.log(sizes[1] / sizes[0])


def _bags(table: pa.Table) -> tuple[list, list[int], float]:
    """Feature counts and labels of the rows of ``sampled``, in its order, and the logarithm of the ratio of their labels."""
    table = table.sort_by([("place", "ascending"), ("label", "ascending")])
    taught = table["label"].to_pylist()
    ones = sum(taught)
    if not 0 < ones < len(taught):
        return [], [], 0.0
    ids, counts = ([np.frombuffer(b.as_buffer(), kind) for b in table[c]] for c, kind in (("ids", "<i4"), ("counts", "<f4")))
    return list(zip(ids, counts, strict=True)), taught, math.log(ones / (len(taught) - ones))


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(parts, ratio): what is learned from the sample, and ``ratio`` as in ``_bags``; no row without both labels."""
    held = [b for b in batches if b.num_rows]
    bags, taught, ratio = _bags(pa.Table.from_batches(held)) if held else ([], [], 0.0)
    if bags:
        parts = pa.array([trained(bags, taught).astype("<f8").tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([parts, pa.array([ratio], pa.float64())], ["parts", "ratio"])


def sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list, list[int], float]:
    """Feature counts and labels of the sample, and what the logit is moved by. For looking at the sample: it comes to the driver."""
    found, prior = sampled(documents, labels, rows)
    bags, taught, ratio = _bags(found.toArrow()) if found is not None else ([], [], 0.0)
    return bags, taught, prior - ratio if bags else 0.0


def scored(
    documents: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", label_id="doc_id", label_column="quality"
) -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: label 1 likelier), predicted (1 from a score of 0.5).

    Learns from the labelled rows it is given and scores every whole text. Labels other than 0 and 1, also null ones, teach
    nothing; a document with both labels teaches by each, once. A null or empty text is scored by the end alone. Without
    labelled rows of both kinds every score is 0.5. Repeated rows and rows without an id are scored like any others.
    """
    rows = picked(documents, doc_id=id_column, text=text_column)
    shared = _fitted(rows, labels, label_id, label_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            scores = pa.array(scorer.scores(batch.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    found = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def filtered(
    documents: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text", label_id="doc_id", label_column="quality"
) -> DataFrame:
    """The rows of ``documents``, all columns, whose text the classifier gives a score of 0.5 or more."""
    rows = picked(documents, doc_id=id_column, text=text_column)
    shared = _fitted(rows, labels, label_id, label_column)
    at = documents.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([s >= 0.5 for s in scorer.scores(batch.column(at))], pa.bool_()))

    plain = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*documents.columns)


def _fitted(rows: DataFrame, labels: DataFrame, label_id: str, label_column: str):
    known = picked(labels, doc_id=label_id, label=label_column).withColumn("label", F.col("label").cast("int"))
    found, prior = sampled(rows, known)
    parts, moved = np.zeros(FEATURES), 0.0
    if found is not None:
        # The sample is bounded, so one task can hold it. In the driver it would stand beside the plans of all that follows.
        learned = found.repartition(1).mapInArrow(_learned, "parts binary, ratio double").first()
        if learned:
            parts, moved = np.frombuffer(learned["parts"], "<f8"), prior - learned["ratio"]
    return rows.sparkSession.sparkContext.broadcast((parts, moved))
