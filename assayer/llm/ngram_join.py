"""Jaccard join of documents on word shingles, by signature trees.

Two documents link when their shingle sets have a Jaccard similarity of at least ``percent`` hundredths. The result is
complete up to collisions of 64-bit hashes; shingles are compared by those.

**Which documents meet.** Linked sets of sizes x and y differ in at most (100 - p)(x + y) / (100 + p) shingles. Sizes fall
into classes so wide that linked sets are in one class or in neighbouring ones. For each such level a set is cut by hash into
one segment more than linked sets there can differ in (and some spare ones, as segments can be empty), so linked sets have a
whole segment in common. The hashes of the segments are the keys. Equal sets are one set with copies, and most documents share
no key and go no further. Keys with the same documents count once. The keys travel once, packed by ranges of their values: a
row holds what one task found in a range, and whoever gets a range sees which of its keys have several documents.

**Signature trees** are used three times. A leaf holds up to ``LEAF`` sets; nodes hold the OR of their bitmaps and the range of their
sizes. A traversal of two nodes at a time goes down only where the sizes and the largest possible overlap allow a link and the
sets are not all connected yet. First the documents of each key are compared by short bitmaps alone, which tell long sets
hardly apart; what can still link makes clusters. Then the documents of each cluster are compared by bitmaps of two bits a
shingle, which leaves smaller clusters. Then the sets of each of these are compared, down to exact counts.

**Large groups**, of either kind, are dealt into blocks of ``BLOCK`` sets. First each block is compared in itself and with some
pivots of the group, which connects the bulk of near copies in one pass. Then only the sets outside the group's largest
component are compared with all blocks of sizes near enough, larger ones of ``SECOND_BLOCK`` sets. Each task returns a spanning forest of its links, never all pairs.

**Numbers of links** (``linked`` only) need every pair of a component, connected already or not. Its distinct sets are dealt
into blocks of at most about ``LINK_BLOCK`` sets and ``LINK_BYTES`` of shingles; every two blocks meet once, overlaps are
counted as products of matrices, and a task returns one number per set, weighted by copies. The work and the rows dealt grow
with the square of a component's distinct sets, the rows by one ``LINK_BLOCK``-th of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.common import ROW_KEY, narrow, picked, row_keyed
from assayer.llm.components import Sets, components, runs
from assayer.session import pinned

LEAF = 8
FAN = 4
BLOCK = 128
PIVOTS = 8
SECOND_BLOCK = 512  # sets of a block in the second pass over large groups,
SECOND_BYTES = 16_000_000  # of at most so many bytes
LONGEST_BITMAP = 32  # words of 64 bits that travel with a key
RANGE_KEYS = 1_000_000  # keys of a range, and of a part of a batch that is dealt over the ranges at once
CACHE_ENTRIES = 200_000
CACHED_BYTES = 64  # words of more bytes are hashed each time
SLICE = 500  # rows signed at a time
CLASS_CODES = 1 << 24  # blocks of a class of sizes are numbered below this
LINK_BLOCK = 2048
LINK_BYTES = 8_000_000
LIGHT = 256  # pairs of sets with a shingle up to which they are listed; beyond that a shingle is a column of a matrix
COLUMNS = 1024
PAIRS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


class Shingler:
    """Shingle sets of texts as sorted 64-bit hashes; keeps the hashes of words it has met."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def set_of(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        hashes = np.fromiter(map(self._hash, words), dtype=np.uint64, count=len(words))
        width = min(self.width, len(words))
        count = len(hashes) - width + 1
        found = np.full(count, width, dtype=np.uint64)
        for k in range(width):
            found = _mixed(found * _MIX2 + hashes[k : k + count])
        return np.unique(found)


    def _hash(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = xxhash.xxh3_64_intdigest(word)
            if len(word) <= CACHED_BYTES:
                self.known[word] = found
        return found


class Levels:
    """Size classes and the keys of sets, for a threshold in hundredths."""

    def __init__(self, percent: int):
        self.percent = percent
        self.starts = [1]

    def class_of(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def segments(self, level: int) -> tuple[int, int]:
        """Segments, and the most that two linked sets of this class and the next can differ in."""
        largest = self.starts[level + 1] - 1
        differ = (100 - self.percent) * (largest + largest * 100 // self.percent) // (100 + self.percent)
        empty = (differ + 1) * np.exp(-self.starts[level] / (differ + 1))
        return differ + 2 + int(3 * empty), differ

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        own = self.class_of(len(shingles))
        found = [self._keys(shingles, level) for level in (own - 1, own) if level >= 0]
        return np.concatenate(found)

    def _keys(self, shingles: np.ndarray, level: int) -> np.ndarray:
        count, differ = self.segments(level)
        spread = _mixed(shingles ^ _mixed(np.array([level + 1], dtype=np.uint64)))
        segment = ((spread >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        begins = np.flatnonzero(np.diff(segment[order], prepend=-1))
        sums = np.add.reduceat(spread[order], begins)
        numbers = segment[order][begins]
        if len(numbers) <= differ:  # too few segments hold anything, so that empty ones must count too
            all_sums = np.zeros(count, dtype=np.uint64)
            all_sums[numbers] = sums
            sums, numbers = all_sums, np.arange(count)
        return _mixed(sums * _MIX2 + _mixed((numbers + (level << 32)).astype(np.uint64)))


def bitmap(shingles: np.ndarray, words: int) -> np.ndarray:
    """A bit for each shingle, in a power of two of 64-bit words; a longer bitmap repeats a shorter one and tells more apart."""
    bits = np.zeros(64 * words, dtype=np.uint8)
    bits[(shingles & np.uint64(64 * words - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view("<u8")


def bitmap_words(size: int) -> int:
    return 1 << max(0, (2 * size - 1).bit_length() - 6)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a worker holds the results of few rows; at the end it gives back what it no longer uses."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)
    pa.default_memory_pool().release_unused()


def _signed(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    shingler, levels = Shingler(width), Levels(percent)
    for batch in _sliced(batches):
        out = []
        for text in batch.column("text"):
            shingles = shingler.set_of(text.as_py() or "")
            if not len(shingles):
                out.append((0, None, None, None, None))
                continue
            words = bitmap_words(len(shingles))
            short = bitmap(shingles, min(LONGEST_BITMAP, words)).tobytes()
            longer = bitmap(shingles, words).tobytes() if words > LONGEST_BITMAP else None
            digest = xxhash.xxh3_128_digest(shingles.tobytes())
            out.append((len(shingles), digest, levels.keys(shingles).view(np.int64), short, longer))
        kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        columns = [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]
        names = ["doc_id", "size", "digest", "keys", "payload", "longer"]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers, all their first bytes, then all their second bytes, …: bytes that change little compress well."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _dealt_keys(batches: Iterator[pa.RecordBatch], ranges: int) -> Iterator[pa.RecordBatch]:
    """(range, keys, docs): the keys of a part of a batch that fall into a range, by their steps, and whose they are."""
    for batch in batches:
        ids, column = batch.column("doc_id").to_numpy(), batch.column("keys")
        offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
        start = 0
        while start < len(ids):
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + RANGE_KEYS, side="right")) - 1)
            keys = values[offsets[start] : offsets[stop]].view(np.uint64)
            order = np.argsort(keys)
            docs = np.repeat(ids[start:stop], np.diff(offsets[start : stop + 1]))[order]
            keys = keys[order]
            number = (keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
            begins = np.flatnonzero(np.diff(number, prepend=np.uint64(ranges)))
            parts = list(zip(begins, [*begins[1:], len(keys)], strict=True))
            arrays = [pa.array(number[begins].astype(np.int64), pa.int64())]
            arrays.append(pa.array([_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in parts], pa.binary()))
            arrays.append(pa.array([_planes(docs[a:b]) for a, b in parts], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, ["range", "keys", "docs"])
            start = stop


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, doc_id), each once, of the keys of each range that have several documents."""
    for rows in runs(batches, ["range"]):
        keys = np.concatenate([np.cumsum(_from_planes(k.as_py()), dtype=np.uint64) for k in rows["keys"]]).view(np.int64)
        docs = np.concatenate([_from_planes(d.as_py()) for d in rows["docs"]]).view(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        same = keys[1:] == keys[:-1]
        several = np.append(same, False) | np.append(False, same)
        keys, docs = keys[several], docs[several]
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        once = np.append(True, (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1]))[: len(keys)]
        keys, docs = keys[once], docs[once]
        same = keys[1:] == keys[:-1]
        several = (np.append(same, False) | np.append(False, same))[: len(keys)]
        arrays = [pa.array(keys[several], pa.int64()), pa.array(docs[several], pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["key", "doc_id"])


def shared_keys(signed: DataFrame) -> DataFrame:
    """(key, doc_id), each once, of the keys that several documents of (doc_id, keys) have. One shuffle, of packed rows.

    A range holds about ``RANGE_KEYS`` keys, each by its document, and with those all documents of a frequent key: 16 bytes each.
    """
    signed = signed.select("doc_id", "keys")
    ranges = -(-(signed.agg(F.sum(F.size("keys").cast("bigint"))).first()[0] or 0) // RANGE_KEYS) or 1
    dealt = signed.mapInArrow(lambda batches: _dealt_keys(batches, ranges), "range bigint, keys binary, docs binary")
    dealt = dealt.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(_shared_keys, "key bigint, doc_id bigint")


def _members(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    shingler = Shingler(width)
    for batch in _sliced(batches):
        sets = [shingler.set_of(t.as_py() or "") for t in batch.column("text")]
        columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
        names = ["family", "doc_id", "size", "payload"]
        yield pa.RecordBatch.from_arrays([batch.column("family"), batch.column("doc_id"), *columns], names)


class Node:
    """A node of a signature tree, or one set: OR of bitmaps, range of sizes, most shingles beyond one a bit, what is below.

    ``times`` is how often the bits repeat what the longest bitmap in them tells."""

    __slots__ = ("bits", "low", "high", "extra", "times", "below", "members", "shingles")

    def __init__(self, bits, low, high, extra, times=1, below=(), members=(), shingles=None):
        self.bits, self.low, self.high, self.extra, self.times = bits, low, high, extra, times
        self.below, self.members, self.shingles = below, members, shingles


def single(number: int, size: int, payload: bytes, exact: bool, words: int) -> Node:
    """A set by its shingles (``exact``) or by its bitmap, with a bitmap of at least so many words."""
    values = np.frombuffer(payload, dtype="<u8")
    bits = bitmap(values, words) if exact else values
    extra = size - int(np.bitwise_count(bits).sum())
    times = max(1, words // len(bits))
    bits = np.tile(bits, times) if times > 1 else bits
    return Node(bits, size, size, extra, times, members=[number], shingles=values if exact else None)


def tree(sets: list[Node]) -> Node:
    """The signature tree of sets, by their sizes and bitmaps."""
    level = sorted(sets, key=lambda s: (s.low, s.bits[0], s.members))
    fan = LEAF
    while len(level) > 1:
        level, fan = [_over(level[a : a + fan]) for a in range(0, len(level), fan)], FAN
    return level[0]


def _over(nodes: list[Node]) -> Node:
    return Node(
        np.bitwise_or.reduce([n.bits for n in nodes]),
        min(n.low for n in nodes),
        max(n.high for n in nodes),
        max(n.extra for n in nodes),
        min(n.times for n in nodes),
        nodes,
        [i for n in nodes for i in n.members],
    )


def may_link(a: Node, b: Node, percent: int) -> bool:
    """Whether sizes and the largest possible overlap allow a link between a set of each."""
    if 100 * a.high < percent * b.low or 100 * b.high < percent * a.low:
        return False
    # what two repeated bitmaps have in common repeats as often as the longer of them
    common = int(np.bitwise_count(a.bits & b.bits).sum()) // min(a.times, b.times)
    overlap = min(common + min(a.extra, b.extra), a.high, b.high)
    return (100 + percent) * overlap >= percent * (a.low + b.low)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(a) + len(b)
    common = both - len(np.unique(np.concatenate([a, b])))
    return 100 * common >= percent * (both - common)


def traverse(first: Node, second: Node, known: Sets, percent: int) -> Iterator[tuple[int, int]]:
    """Links between sets of two nodes (of one, if they are the same) that join what was not connected."""
    pending = [(first, second)]
    while pending:
        a, b = pending.pop()
        if a is b:
            pending += [(p, q) for k, p in enumerate(a.below) for q in a.below[k:]]
        elif may_link(a, b, percent) and len({known.find(i) for n in (a, b) for i in n.members}) > 1:
            if a.below and (not b.below or len(a.members) >= len(b.members)):
                pending += [(p, b) for p in a.below]
            elif b.below:
                pending += [(a, q) for q in b.below]
            elif a.shingles is None or similar(a.shingles, b.shingles, percent):
                known.join(a.members[0], b.members[0])
                yield a.members[0], b.members[0]


def _compared(batches: Iterator[pa.RecordBatch], percent: int, exact: bool) -> Iterator[pa.RecordBatch]:
    """Spanning links of each unit (family, x, y): of side 0 in itself, and of side 0 with side 1 where there is one."""
    for rows in runs(batches, ["family", "x", "y"]):
        ids, sizes, component = (rows[c].to_pylist() for c in ("doc_id", "size", "component"))
        side = rows["side"].to_pylist()
        if len(ids) < 2 or 0 not in side:
            continue
        words = bitmap_words(max(sizes)) if exact else max(len(p.as_py()) for p in rows["payload"]) // 8
        sets = [single(i, sizes[i], p.as_py(), exact, words) for i, p in enumerate(rows["payload"])]
        known, first = Sets(len(sets)), {}
        for i, c in enumerate(component):
            if c is not None:
                known.join(i, first.setdefault(c, i))
        left, right = ([s for s, k in zip(sets, side, strict=True) if k == n] for n in (0, 1))
        a = tree(left)
        found = list(traverse(a, a, known, percent))
        if right:
            found += traverse(a, tree(right), known, percent)
        yield pa.RecordBatch.from_arrays(
            [pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())], ["a", "b"]
        )


def _unit_links(units: DataFrame, percent: int, exact: bool) -> DataFrame:
    order = ["family", "x", "y"]
    units = units.select(*order, "side", "component", "doc_id", "size", "payload")
    dealt = units.repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(lambda batches: _compared(batches, percent, exact), "a bigint, b bigint")


def connected(members: DataFrame, percent: int, exact: bool) -> DataFrame:
    """(node, component) for the documents that link with another of a family, directly or through others.

    ``members`` is a stored table of (family, doc_id, size, payload); a document can be in several families. The payload is
    the set of shingles (``exact``) or its bitmap; by the bitmap all that can link does.
    """
    sizes = pinned(members.groupBy("family").agg(F.count(F.lit(1)).alias("all")))
    dealt = members.join(narrow(sizes), "family").withColumn("blocks", F.ceil(F.col("all") / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.col("all")) < PIVOTS)
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    within = dealt.withColumn("x", F.col("block"))
    within = within.union(dealt.where(pivot).withColumn("x", everywhere).where("x != block"))
    within = within.withColumns({"y": F.lit(-1), "side": F.lit(0), "component": F.lit(None).cast("bigint")})
    found = pinned(_unit_links(within, percent, exact))
    named = components(found)
    if sizes.where(F.col("all") > BLOCK).isEmpty():
        return named
    # What is left in families of several blocks: sets outside the largest component, against all blocks.
    large = dealt.where("blocks > 1").drop("all")
    split = large.join(narrow(named).withColumnRenamed("node", "doc_id"), "doc_id", "left")
    split = pinned(split.withColumn("component", F.coalesce("component", "doc_id")))
    parts = split.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", "component"))
    main = parts.groupBy("family").agg(largest["component"].alias("main"), (F.sum("n") - F.max("n")).alias("rest"))
    main = pinned(main.where("rest > 0").select("family", "main"))
    if main.isEmpty():
        return named
    # Both sides are dealt by classes of sizes, so wide that linked sets are in one or in neighbouring ones.
    split = split.join(narrow(main), "family").withColumn("class", _size_class("size", percent))
    outside = F.col("component") != F.col("main")
    length = F.octet_length("payload").cast("bigint")
    classes = split.groupBy("family", "class").agg(
        _blocks_for(F.count(F.lit(1)), F.sum(length)).alias("n"),
        _blocks_for(F.count_if(outside), F.coalesce(F.sum(F.when(outside, length)), F.lit(0))).alias("rest"),
    )
    split = split.join(narrow(pinned(_neighbours(classes))), ["family", "class"])  # one look-up for each row
    x, y = (F.col("class") * CLASS_CODES + F.pmod(F.xxhash64("doc_id"), F.col(c)) for c in ("rest", "n"))
    left = split.where(outside).withColumns({"x": x, "side": F.lit(0)}).withColumn("y", F.explode("blocks_near"))
    right = split.withColumns({"x": F.explode("parts_near"), "own": F.when(outside, x)})
    right = right.where("own IS NULL OR own <> x").withColumns({"y": y, "side": F.lit(1)})
    columns = ["family", "x", "y", "side", "component", "doc_id", "size", "payload"]
    left, right = left.select(*columns), right.select(*columns)
    rest = pinned(_unit_links(left.union(right), percent, exact))
    return components(named.select(F.col("node").alias("a"), F.col("component").alias("b")).union(rest))


def _blocks_for(count: Column, size: Column) -> Column:
    return F.ceil(F.greatest(count / SECOND_BLOCK, size / SECOND_BYTES)).cast("int")


def _size_class(size: str, percent: int) -> Column:
    """A little wider than needed, so that rounding parts no linked sizes by more than one class."""
    return F.floor(F.log(F.col(size)) / (1.0001 * math.log(100 / min(percent, 99)))).cast("bigint")


def _neighbours(classes: DataFrame) -> DataFrame:
    """For each class of a family its blocks (``n``) and parts outside (``rest``), and the numbers of those in it and next to it.

    Only classes with a part outside in or next to them: no others are compared.
    """

    def numbers(count: str) -> Column:
        base = F.col("class") * CLASS_CODES
        some = F.transform(F.sequence(F.lit(0), F.col(count) - 1), lambda i: base + i)
        return F.when(F.col(count) > 0, some).otherwise(F.array().cast("array<bigint>"))

    found = classes.select("*", numbers("n").alias("blocks_near"), numbers("rest").alias("parts_near"))
    found = found.withColumn("step", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    found = found.withColumn("class", F.col("class") + F.col("step"))
    own = [F.max(F.when(F.col("step") == 0, F.col(c))).alias(c) for c in ("n", "rest")]
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("blocks_near", "parts_near")]
    near = found.groupBy("family", "class").agg(*own, *lists)
    return near.where(F.col("n").isNotNull() & (F.size("parts_near") > 0))


def candidates(signed: DataFrame, percent: int) -> DataFrame:
    """(node, component): documents that can link with another by size and bitmap, and their cluster."""
    usable = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    firsts = usable.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = usable.select("digest", "doc_id").join(narrow(pinned(firsts)), "digest").where("doc_id != first").select("doc_id", "digest")
    own = usable.join(narrow(pinned(copies)), ["doc_id", "digest"], "left_anti")
    several = pinned(shared_keys(own))  # most keys have one document and go no further
    # What tells the documents of a key: ends, number, and two sums of hashes.
    hashed = F.xxhash64("doc_id")
    told = {"a": F.min("doc_id"), "b": F.max("doc_id"), "n": F.count(F.lit(1)), "odd": F.bit_xor(hashed)}
    told["all"] = F.sum(F.pmod(hashed, F.lit(1 << 31)))
    groups = several.groupBy("key").agg(*[c.alias(n) for n, c in told.items()])
    groups = pinned(groups.groupBy(*told).agg(F.min("key").alias("key")).select("key"))
    shared = pinned(several.join(narrow(groups), "key").select(F.col("key").alias("family"), "doc_id"))
    members = pinned(own.select("doc_id", "size", "payload").join(narrow(shared), "doc_id"))
    return connected(members, percent, exact=False)


def joined(documents: DataFrame, percent: int = 90, width: int = 3, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links, its own included).

    A set has the distinct shingles of ``width`` words; fewer words are one shingle. Words are runs between blanks, tabs and
    line ends, A-Z in lower case. Null and empty texts and those without words have an empty set and link with nothing, nor
    do rows without an id, whose component is null. Rows that repeat an id share one component. Equal sets always link. An
    empty table gives no rows.
    """
    rows = picked(documents, doc_id=id_column, text=text_column)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    signed, _, named = _classed(rows, percent, width)
    # Copies take the component of the first document with their set.
    usable = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "digest")
    firsts = usable.groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = firsts.join(narrow(named).withColumnRenamed("node", "first"), "first", "left")
    classes = pinned(firsts.select("digest", F.coalesce("component", "first").alias("class")))
    found = signed.select("doc_id", "size", "digest").join(classes, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    return found.select(F.col("doc_id").alias(id_column), F.col("size").alias("n_shingles"), component.alias("component_id"))


def _classed(rows: DataFrame, percent: int, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For rows (doc_id, text): their signatures, the sets that were compared, and (node, component) of those that link."""
    schema = "doc_id bigint, size bigint, digest binary, keys array<bigint>, payload binary, longer binary"
    signed = pinned(rows.mapInArrow(lambda batches: _signed(batches, width, percent), schema))
    named = candidates(signed, percent)
    clusters = pinned(named.select(F.col("node").alias("doc_id"), F.col("component").alias("family")))
    # Long sets once more, by bitmaps as long as they need, before any set itself travels.
    longer = signed.where("size > 0").select("doc_id", "size", F.coalesce("longer", "payload").alias("payload"))
    longer = pinned(longer.join(narrow(clusters), "doc_id").select("family", "doc_id", "size", "payload"))
    named = connected(longer, percent, exact=False)
    clusters = pinned(named.select(F.col("node").alias("doc_id"), F.col("component").alias("family")))
    texts = rows.join(narrow(clusters), "doc_id").select("family", "doc_id", "text")
    schema = "family bigint, doc_id bigint, size bigint, payload binary"
    members = pinned(texts.mapInArrow(lambda batches: _members(batches, width), schema))
    return signed, members, connected(members, percent, exact=True)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set of one list shares with each of the other."""
    m, k = len(left), len(right)
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(m + k), [len(s) for s in chain(left, right)])
    order = np.argsort(values, kind="stable")  # the left owners of a shingle come first
    values, owner = values[order], owner[order]
    begins = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    column = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(values)))
    on_left = owner < m
    a = np.bincount(column[on_left], minlength=len(begins))
    b = np.bincount(column[~on_left], minlength=len(begins))
    found = np.zeros(m * k, dtype=np.int64)
    # Shingles of few pairs, pair by pair.
    light = np.flatnonzero(on_left & ((a * b > 0) & (a * b <= LIGHT))[column])
    times = b[column[light]]
    part = np.cumsum(times) // PAIRS
    cuts = np.flatnonzero(np.diff(part)) + 1
    for at, n in zip(np.split(light, cuts), np.split(times, cuts), strict=True):
        if not len(at):
            continue
        c = column[at]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        other = owner[np.repeat(begins[c] + a[c], n) + within] - m
        found += np.bincount(np.repeat(owner[at], n) * k + other, minlength=m * k)
    found = found.reshape(m, k)
    # The others as columns of two matrices of zeros and ones.
    heavy = np.flatnonzero(a * b > LIGHT)
    for start in range(0, len(heavy), COLUMNS):
        some = heavy[start : start + COLUMNS]
        number = np.full(len(begins), -1)
        number[some] = np.arange(len(some))
        at = np.flatnonzero(number[column] >= 0)
        bits = np.zeros((m + k, len(some)), dtype=np.float32)
        bits[owner[at], number[column[at]]] = 1
        found += np.rint(bits[:m] @ bits[m:].T).astype(np.int64)
    return found


def _linked_weights(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """For each set of a unit (component, x, y), the copies of the sets it links with there: in itself, or across the sides."""
    for rows in runs(batches, ["component", "x", "y"]):
        ids, weights, side = (rows[c].to_numpy() for c in ("doc_id", "copies", "side"))
        sets = [np.frombuffer(p.as_py(), dtype="<u8") for p in rows["payload"]]
        sizes = np.array([len(s) for s in sets])
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = rows["x"][0].as_py() == rows["y"][0].as_py()
        second = first if alone else second
        if not len(first) or not len(second):
            continue
        common = overlaps([sets[i] for i in first], [sets[j] for j in second])
        totals = np.zeros(len(ids), dtype=np.int64)
        for at, i in enumerate(first):
            both = sizes[i] + sizes[second]
            links = 100 * common[at] >= percent * (both - common[at])
            if alone:
                links[at] = False
            else:
                totals[second] += links * weights[i]
            totals[i] += weights[second] @ links
        kept = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(ids[kept], pa.int64()), pa.array(totals[kept], pa.int64())], ["doc_id", "n"])


def link_counts(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, n) for stored sets (component, doc_id, copies, payload): the copies of all sets of the component that link."""
    total = F.sum(F.length("payload").cast("bigint"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / LINK_BLOCK), F.ceil(total / LINK_BYTES)).cast("int")
    dealt = sets.join(narrow(pinned(sets.groupBy("component").agg(blocks.alias("blocks")))), "component")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    order = ["component", "x", "y"]
    units = dealt.select(
        "component",
        F.least("block", "other").alias("x"),
        F.greatest("block", "other").alias("y"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
        "doc_id",
        "copies",
        "payload",
    )
    units = units.repartition(*order).sortWithinPartitions(*order)
    counts = units.mapInArrow(lambda batches: _linked_weights(batches, percent), "doc_id bigint, n bigint")
    return counts.groupBy("doc_id").agg(F.sum("n").alias("n"))


def linked(documents: DataFrame, percent: int = 90, width: int = 3, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links (the number of other rows that it links with).

    Sets and links are those of ``joined``, but rows count, not ids: rows that repeat an id or have none link like any others
    and have a component each, which is named by its smallest id (null where no row of it has one). Every link counts on both
    its sides, also where the rows are connected through others. A row that links with nothing has 0.
    """
    keyed = row_keyed(documents)
    ids = picked(keyed, node=ROW_KEY, id=id_column)
    rows = picked(keyed, doc_id=ROW_KEY, text=text_column)
    signed, members, named = _classed(rows, percent, width)
    signed = signed.select(F.col("doc_id").alias("node"), "size", "digest")
    signed = pinned(signed.join(ids.withColumn("id", F.col("id").cast("bigint")), "node"))
    firsts = signed.where("digest IS NOT NULL").groupBy("digest")
    firsts = pinned(firsts.agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")))
    within = pinned(firsts.join(narrow(named), "node").select("node", "component", "copies", "least"))
    sets = members.select("doc_id", "payload").join(narrow(within.select(F.col("node").alias("doc_id"), "component", "copies")), "doc_id")
    counts = pinned(link_counts(pinned(sets), percent)).withColumnRenamed("doc_id", "node")
    smallest = pinned(within.groupBy("component").agg(F.min("least").alias("smallest")))
    within = pinned(within.select("node", "component").join(narrow(smallest), "component").join(narrow(counts), "node", "left"))
    classes = firsts.join(narrow(within), "node", "left").select(
        "digest",
        # all of a component may be without an id
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
    )
    found = signed.join(pinned(classes), "digest", "left")
    alone = F.col("digest").isNull()
    return found.select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
