"""Language-model scores from a weighted backoff automaton over smoothed n-grams.

**Model.** Order n (default 2). Unigrams: p1(w) = (c(w) + 1/2) / (N + (V + 1) / 2). Longer n-grams use Dirichlet smoothing:
p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m) with m = ``PRIOR`` and h' one word shorter; it sums to one for every h. Every
text starts after a begin symbol, which is the end token of the text before it, and ends with one end token.

**Automaton.** A state is a context seen in training. It has an arc for each word seen after it, weighted by log10 p(w | h),
and a failure arc to the state of h', weighted by log10(m / (c(h) + m)). The root has an arc for every word. One traversal
from left to right carries the state and adds up the weights; the texts of a block are traversed together, as arrays.

**At scale.** Texts stay where they are. A task turns them into blocks of about ``BLOCK_BYTES`` (word numbers and 64-bit word
hashes), which are stored in buckets, so that later steps read them where they lie and only requests and answers are
shuffled. Each block asks for the counts of its distinct n-grams, dealt by ranges of their hashes; a range adds up the counts
of all blocks and answers in the order it was asked. Words and pairs are asked for first. A longer n-gram is asked for only
if another block has its context too and a training text has it: otherwise its count is that in its own block, or zero. A
block then builds the part of the automaton that its own texts can reach. No n-gram is dropped, and no task holds more than
one block or one range.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import picked
from assayer.session import pinned, scratch_path

PRIOR = 8.0
BLOCK_BYTES = 5_000_000
RANGE_ENTRIES = 2_000_000
FIRST_LEVELS = 2  # asked for in the first round
END = 0  # number of the end token, which is also the begin symbol of the next text
_MIX = np.uint64(0x9E3779B97F4A7C15)


def remainder(identifier: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(identifier.cast("string")) % parts


def words_of(text: str) -> list[bytes]:
    """Words between white space (blank, tab to carriage return), A-Z in lower case."""
    return text.encode().lower().split()


def _packed(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on: high bytes are mostly alike."""
    return zlib.compress(values.view("u1").reshape(-1, values.itemsize).T.tobytes(), 1)


def _array(packed: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), dtype="u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _steps(hashes: np.ndarray) -> bytes:
    """Sorted hashes by their differences, which are shorter."""
    return _packed(np.diff(hashes, prepend=np.uint64(0)))


class Grams:
    """The distinct n-grams of a block: numbers per position and level, hashes, training counts."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, word_hashes: np.ndarray, order: int):
        ends = np.cumsum(lengths)
        self.codes = codes
        self.document = np.repeat(np.arange(len(lengths)), lengths)
        self.place = place = np.arange(len(codes)) - np.repeat(ends - lengths, lengths)
        # By level, from 1: the n-gram that ends at each position (-1: none), and hash, a position and the context of each.
        self.at, self.hashes, self.sample, self.context = [codes], [word_hashes], [np.zeros(0, dtype=np.int64)], [None]
        for level in range(2, order + 1):
            before = np.append(np.int64(END), self.at[-1][:-1])
            if level == 2:
                before[place == 0] = END
            whole = place >= level - 2
            if level > 2:
                whole &= before >= 0
            keys = before[whole] * len(word_hashes) + codes[whole]
            distinct, sample, inverse = np.unique(keys, return_index=True, return_inverse=True)
            at = np.full(len(codes), -1, dtype=np.int64)
            at[whole] = inverse
            context, word = np.divmod(distinct, len(word_hashes))
            hashes = (self.hashes[-1][context] + np.uint64(level)) * _MIX
            hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX + word_hashes[word]
            self.at.append(at)
            self.hashes.append((hashes ^ (hashes >> np.uint64(29))) * _MIX)
            self.sample.append(np.flatnonzero(whole)[sample])
            self.context.append(context)

    def counts(self, learned: np.ndarray, level: int) -> np.ndarray:
        """How often each n-gram of a level occurs in the texts that are learned from."""
        at = self.at[level - 1]
        return np.bincount(at[(at >= 0) & learned[self.document]], minlength=len(self.hashes[level - 1]))


def _blocks(batches: Iterator[pa.RecordBatch], schema: list[str]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as word numbers; numbers count from 1 in a block, 0 is the end."""
    task, number = TaskContext.get().partitionId(), 0
    ids, learned, texts, size = [], [], [], 0

    def block() -> pa.RecordBatch:
        known: dict[bytes, int] = defaultdict()
        known.default_factory = lambda: len(known) + 1
        split = [words_of(t) for t in texts]
        lengths = np.array([len(w) + 1 for w in split], dtype="<i8")
        codes = np.zeros(int(lengths.sum()), dtype="<i4")
        stop = np.cumsum(lengths) - 1
        inside = np.ones(len(codes), dtype=bool)
        inside[stop] = False
        numbers = map(known.__getitem__, chain.from_iterable(split))
        codes[inside] = np.fromiter(numbers, dtype="<i4", count=len(codes) - len(stop))
        hashes = np.array([xxhash.xxh3_64_intdigest(b" "), *map(xxhash.xxh3_64_intdigest, known)], dtype="<u8")
        values = [
            pa.array([task << 32 | number], pa.int64()),
            pa.array([ids], pa.list_(id_type)),
            pa.array([_packed(np.array(learned, dtype="u1"))], pa.binary()),
            pa.array([_packed(lengths)], pa.binary()),
            pa.array([_packed(codes)], pa.binary()),
            pa.array([_packed(hashes)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(values, schema)

    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        for key, keep, text in zip(*(batch.column(c) for c in ("doc_id", "learned", "text")), strict=True):
            ids.append(key.as_py())
            learned.append(keep.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= BLOCK_BYTES:
                yield block()
                number += 1
                ids, learned, texts, size = [], [], [], 0
    if texts:
        yield block()


def _read(row: dict, order: int) -> tuple[Grams, np.ndarray, np.ndarray]:
    learned = _array(row["learned"], "u1").astype(bool)
    lengths = _array(row["lengths"], "<i8")
    codes = _array(row["codes"], "<i4").astype(np.int64)
    return Grams(codes, lengths, _array(row["hashes"], "<u8"), order), learned, lengths


def _bounds(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of the equal ranges of 64-bit hashes begins and ends in sorted hashes."""
    edges = [(r << 64) // ranges for r in range(1, ranges)]
    return np.concatenate([[0], np.searchsorted(hashes, np.array(edges, dtype=np.uint64)), [len(hashes)]])


def _placed(answers: list[dict], level: int) -> np.ndarray:
    """What a block was given for what it asked of a level, in the order of the hashes."""
    own = [_array(r["totals"], "<i8") for r in sorted(answers, key=lambda r: r["range"]) if r["level"] == level]
    return np.concatenate(own) if own else np.zeros(0, dtype=np.int64)


class Totals:
    """Training counts over all blocks of the n-grams of one block, level by level."""

    def __init__(self, grams: Grams, learned: np.ndarray, answers: list[dict], levels: int):
        self.grams, self.learned = grams, learned
        self.found: list[np.ndarray] = []
        self.shared: list[np.ndarray] = []  # what another block has too and a training text has
        for level in range(1, levels + 1):
            asked = np.flatnonzero(self.asked(level))
            places = asked[np.argsort(grams.hashes[level - 1][asked])]
            total, shared = grams.counts(learned, level).astype(np.int64), np.zeros(len(grams.hashes[level - 1]), dtype=bool)
            given = _placed(answers, level)
            total[places] = given >> 1
            shared[places] = (given > 1) & (given & 1 == 0)
            self.found.append(total)
            self.shared.append(shared)

    def asked(self, level: int) -> np.ndarray:
        """Which n-grams of a level the block asks for. The count of any other is that of the block itself: all texts with
        its context are in this block, or no training text has the context."""
        if level <= FIRST_LEVELS:
            return np.ones(len(self.grams.hashes[level - 1]), dtype=bool)
        return self.shared[level - 2][self.grams.context[level - 1]]

    def requests(self, block: int, level: int, ranges: int) -> Iterator[tuple]:
        """(block, level, range, hashes, counts): what a block asks for on a level and what it adds."""
        asked = self.asked(level)
        hashes, counts = self.grams.hashes[level - 1][asked], self.grams.counts(self.learned, level)[asked]
        by_hash = np.argsort(hashes)
        hashes, counts = hashes[by_hash], counts[by_hash].astype("<u4")
        bounds = _bounds(hashes, ranges)
        for r, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if a < b:
                yield block, level, r, _steps(hashes[a:b]), _packed(counts[a:b])


_REQUEST = pa.schema(
    [("block", pa.int64()), ("level", pa.int32()), ("range", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())]
)
_REQUEST_SQL = "block bigint, level int, range int, hashes binary, counts binary"


def _request_table(rows: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_REQUEST)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _REQUEST, strict=True)], schema=_REQUEST)


def _first_requests(batches: Iterator[pa.RecordBatch], order: int, ranges: int) -> Iterator[pa.RecordBatch]:
    levels = min(order, FIRST_LEVELS)
    for batch in batches:
        for row in batch.to_pylist():
            grams, learned, _ = _read(row, levels)
            totals = Totals(grams, learned, [], 0)
            rows = chain.from_iterable(totals.requests(row["block"], level, ranges) for level in range(1, levels + 1))
            yield from _request_table(rows).to_batches()


def _later_requests(level: int, ranges: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        grams, learned, _ = _read(row, level)
        return _request_table(Totals(grams, learned, answers.to_pylist(), level - 1).requests(row["block"], level, ranges))

    return run


def _answers(rows: pa.Table) -> pa.Table:
    """For one range of one level: the totals, in the order each block asked, and what they come to.

    A total is doubled, and one more where no other block asked for the n-gram.
    """
    asked = [np.cumsum(_array(h.as_py(), "<u8"), dtype=np.uint64) for h in rows["hashes"]]
    own = np.concatenate([_array(c.as_py(), "<u4") for c in rows["counts"]])
    distinct, inverse = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(inverse, weights=own, minlength=len(distinct)).astype("<i8")
    alone = np.bincount(inverse, minlength=len(distinct)) == 1
    answers = np.split((2 * totals + alone)[inverse], np.cumsum([len(a) for a in asked])[:-1])
    first = np.arange(len(asked)) == 0
    return pa.table(
        {
            "block": rows["block"],
            "level": rows["level"],
            "range": rows["range"],
            "totals": pa.array([_packed(a) for a in answers], pa.binary()),
            # What the whole range has, stated once.
            "tokens": pa.array(np.where(first, totals.sum(), 0), pa.int64()),
            "types": pa.array(np.where(first, np.count_nonzero(totals), 0), pa.int64()),
        }
    )


class Automaton:
    """The part of the automaton that the n-grams of one block can reach, by the numbers of the n-grams.

    ``arcs[k]`` has the weight of the arc that reads the last word of each n-gram of k + 1 words (NaN: no such arc), and
    ``back[k]`` that of the failure arc out of the state of each context of k + 1 words.
    """

    def __init__(self, grams: Grams, totals: list[np.ndarray], base: np.ndarray):
        """``base``: log10 of the unigram probability of each word number."""
        self.grams, self.totals = grams, totals
        self.arcs, self.back = [base], [np.log10(PRIOR / (count + PRIOR)) for count in totals[:-1]]
        p = 10.0**base  # of the last word of each n-gram after a context one word shorter
        for level in range(1, len(totals)):
            count = totals[level - 1][grams.context[level]]
            shorter = p[grams.at[level - 1][grams.sample[level]]]
            p = (totals[level] + PRIOR * shorter) / (count + PRIOR)
            self.arcs.append(np.where(totals[level] > 0, np.log10(p), np.nan))

    def weights(self) -> np.ndarray:
        """What each step from left to right adds, for all texts of the block at once.

        The state before a word is the longest context in training: the n-gram whose arc read the word before, cut to the
        length of the longest context. From there failure arcs lead down to the first state that has an arc for the word.
        """
        grams, order = self.grams, len(self.arcs)
        taken, total = np.zeros(len(grams.codes), dtype=np.int64), self.arcs[0][grams.codes]
        for level in range(1, order):
            at = grams.at[level]
            weight = np.append(self.arcs[level], np.nan)[at]  # the last one for positions without an n-gram
            has = ~np.isnan(weight)
            taken[has], total[has] = level, weight[has]
        known = taken + ((taken > 0) | (self.totals[0][grams.codes] > 0))  # words of the n-gram just read, 0 if unseen
        state = np.minimum(np.append(0, known[:-1]), order - 1)
        begin = grams.place == 0
        state[begin] = min(int(self.totals[0][END] > 0), order - 1)
        for level in range(1, order):
            context = np.append(np.int64(END), grams.at[level - 1][:-1])
            if level == 1:
                context[begin] = END
            fails = np.flatnonzero((state >= level) & (taken < level))
            total[fails] += self.back[level - 1][context[fails]]
        return total


def _scored(block: pa.Table, answers: pa.Table, order: int, tokens: int, types: int) -> pa.Table:
    row = block.to_pylist()[0]
    grams, learned, lengths = _read(row, order)
    totals = Totals(grams, learned, answers.to_pylist(), order).found
    base = np.log10((totals[0] + 0.5) / (tokens + 0.5 * (types + 1)))
    begins = np.cumsum(lengths) - lengths
    return pa.table(
        {
            "doc_id": block["ids"].combine_chunks().flatten(),
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat(totals[0][grams.codes] > 0, begins, dtype=np.int64), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base[grams.codes], begins), pa.float64()),
            "score": pa.array(np.add.reduceat(Automaton(grams, totals, base).weights(), begins), pa.float64()),
        }
    )


def _stored(blocks: DataFrame, buckets: int) -> DataFrame:
    """The blocks as a table in buckets: groups of a block's rows are formed without a shuffle."""
    name = f"blocks_{uuid.uuid4().hex}"
    blocks.write.bucketBy(buckets, "block").option("path", scratch_path(blocks.sparkSession, name)).saveAsTable(name)
    return blocks.sparkSession.table(name)


def _answered(asked: DataFrame) -> DataFrame:
    kinds = "block bigint, level int, range int, totals binary, tokens bigint, types bigint"
    return pinned(asked.groupBy("level", "range").applyInArrow(_answers, kinds))


def scored(documents: DataFrame, learned: Column, order: int = 2, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: doc_id, learned, n_tokens, n_known, train_tokens, base_score, score.

    ``learned`` is a condition on ``doc_id``: the model learns from the rows where it holds; null counts as false. A null
    text counts as empty and has the end token alone. Rows that repeat an id are scored each and count each. Without any
    row to learn from, all words are unknown and every p(w) is one half over one half, so all scores are 0. An empty table
    gives no rows.
    """
    spark = documents.sparkSession
    rows = picked(documents, doc_id=id_column, text=text_column)
    rows = rows.withColumn("learned", F.coalesce(learned, F.lit(False)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["block", "ids", "learned", "lengths", "codes", "hashes"]
    schema = f"block bigint, ids array<{kind}>, learned binary, lengths binary, codes binary, hashes binary"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _stored(rows.mapInArrow(lambda batches: _blocks(batches, names), schema), parts)
    size = blocks.agg(F.count(F.lit(1)).alias("n")).first()["n"] * BLOCK_BYTES
    ranges = max(-(-size // 6 // RANGE_ENTRIES), parts)
    texts = blocks.select("block", "learned", "lengths", "codes", "hashes")
    asked = texts.mapInArrow(lambda batches: _first_requests(batches, order, ranges), _REQUEST_SQL)
    answers = _answered(asked)
    for level in range(FIRST_LEVELS + 1, order + 1):
        given = texts.groupBy("block").cogroup(answers.select("block", "level", "range", "totals").groupBy("block"))
        asked = given.applyInArrow(_later_requests(level, ranges), _REQUEST_SQL)
        answers = answers.union(_answered(asked))
    whole = answers.where("level = 1").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).first()
    tokens, types = whole["tokens"] or 0, whole["types"] or 0
    found = blocks.groupBy("block").cogroup(answers.select("block", "level", "range", "totals").groupBy("block"))
    result = found.applyInArrow(
        lambda block, totals: _scored(block, totals, order, tokens, types),
        f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    result = result.withColumns({"learned": F.coalesce(learned, F.lit(False)), "train_tokens": F.lit(tokens).cast("long")})
    return result.select("doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score")
