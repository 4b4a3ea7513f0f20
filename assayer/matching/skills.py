"""Skills in texts: extraction of vocabulary phrases, and normalisation of misspelt names."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.session import pinned

WORD = r"[\p{L}\p{N}+#]+"  # c++ and c# are words
BLOCK_BYTES = 16 << 20  # of phrases in one automaton
LONG_NAME = 32  # names of more characters are indexed by segments, as their deletions grow with the square of the length


def words(text: Column) -> Column:
    """The words of a text in lower case; none for a null text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def phrases(texts: DataFrame, text_column: str = "text", longest: int = 3) -> DataFrame:
    """(phrase): all different runs of one to ``longest`` words of the texts."""
    split = texts.select(words(F.col(text_column)).alias("words"))
    none = F.array().cast("array<string>")

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("words") - (n - 1))
        found = F.transform(starts, lambda i: F.array_join(F.slice("words", i, n), " "))
        return F.when(F.size("words") >= n, found).otherwise(none)

    every = F.flatten(F.array(*[runs(n) for n in range(1, longest + 1)]))
    return split.select(F.explode(every).alias("phrase")).distinct()


class PhraseAutomaton:
    """A trie of phrases over word numbers, with failure links to the longest suffix that begins a phrase."""

    def __init__(self, vocabulary: list[str]):
        self.numbers: dict[str, int] = {}  # of words, from 1
        self.arcs: dict[int, int] = {}  # by state and word
        self.phrases = vocabulary
        ends = {0: -1}
        depth = [0]
        for k, phrase in enumerate(vocabulary):
            state = 0
            for word in phrase.split(" "):
                arc = state << 32 | self.numbers.setdefault(word, len(self.numbers) + 1)
                if arc not in self.arcs:
                    self.arcs[arc] = len(depth)
                    depth.append(depth[state] + 1)
                state = self.arcs[arc]
            ends[state] = k
        self.fail = [0] * len(depth)
        # phrase and length of the longest phrase that ends in each state (-1 and 0: none does)
        self.phrase, self.length = [-1] * len(depth), [0] * len(depth)
        below: dict[int, list[tuple[int, int]]] = {}
        for arc, target in self.arcs.items():
            below.setdefault(arc >> 32, []).append((arc & 0xFFFFFFFF, target))
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for word, target in below.get(state, ()):
                self.fail[target] = self.step(self.fail[state], word) if state else 0
                queue.append(target)
            if state in ends and state:
                self.phrase[state], self.length[state] = ends[state], depth[state]
            elif state:
                back = self.fail[state]
                self.phrase[state], self.length[state] = self.phrase[back], self.length[back]

    def step(self, state: int, word: int) -> int:
        """The state after reading a word."""
        while True:
            target = self.arcs.get(state << 32 | word)
            if target is not None:
                return target
            if not state:
                return 0
            state = self.fail[state]

    def longest_matches(self, codes: list[int]) -> list[tuple[int, int, int]]:
        """(start, end, phrase) of the matches that lie in no longer one. Code 0 is a word that no phrase has."""
        state, ends = 0, []
        for place, code in enumerate(codes):
            state = self.step(state, code) if code else 0
            if self.length[state]:
                ends.append((place + 1 - self.length[state], place + 1, self.phrase[state]))
        found, least = [], len(codes) + 1
        for match in reversed(ends):
            if match[0] < least:
                least = match[0]
                found.append(match)
        return found[::-1]


EMITTED = 200_000  # matches that a task holds at once, about


def _matched(batches: Iterator[pa.RecordBatch], shared, form: str) -> Iterator[pa.RecordBatch]:
    """Rows (id, phrase, n); (row, id, start, end, phrase) as ``places``; or (id, phrases) as ``packed``, one row a text."""
    automaton = shared.value
    names = pa.array(automaton.phrases, pa.string())
    for batch in batches:
        lists = batch.column("words")
        flat = lists.flatten().dictionary_encode()
        known = np.array([automaton.numbers.get(w, 0) for w in flat.dictionary.to_pylist()], dtype=np.int64)
        codes = known[flat.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, dtype=np.int64)
        cuts = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
        out: list[tuple] = []
        for place, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            found = automaton.longest_matches(codes[a:b].tolist())
            if form == "places":
                out += [(place, k, start, end) for start, end, k in found]
            else:
                which, times = np.unique([k for *_, k in found], return_counts=True)
                out += [(place, k, n) for k, n in zip(which.tolist(), times.tolist(), strict=True)]
            if len(out) >= EMITTED:
                yield _rows(batch, out, names, form)
                out = []
        if out:
            yield _rows(batch, out, names, form)


def _rows(batch: pa.RecordBatch, out: list[tuple], names: pa.Array, form: str) -> pa.RecordBatch:
    places, phrases, *more = (np.array(column, dtype=np.int64) for column in zip(*out, strict=True))
    if form == "packed":  # the matches of a text are never parted
        texts, begin = np.unique(places, return_index=True)
        found = pa.ListArray.from_arrays(pa.array(np.append(begin, len(places)), pa.int32()), names.take(pa.array(phrases)))
        return pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(texts)), found], ["id", "phrases"])
    columns = {"id": batch.column("id").take(pa.array(places)), "phrase": names.take(pa.array(phrases))}
    if form == "places":
        columns = {"row": batch.column("row").take(pa.array(places)), **columns}
    labels = ("start", "end") if form == "places" else ("n",)
    return pa.RecordBatch.from_pydict(columns | {label: pa.array(values) for label, values in zip(labels, more, strict=True)})


def extracted(texts: DataFrame, vocabulary: DataFrame, id_column: str, text_column: str = "text", phrase_column: str = "phrase", packed: bool = False) -> DataFrame:
    """(id, phrase, n): how often each vocabulary phrase occurs in each text, longest match first.

    A phrase is a run of whole words. A match that lies inside a longer one does not count; matches that only overlap count
    both. Null and empty texts, and texts without any phrase, give no rows; rows that repeat an id are texts of their own.
    Phrases are brought to lower-case words first; null ones and those without words are left out.

    The vocabulary is measured. Up to ``BLOCK_BYTES`` it is one automaton, which every task gets; a larger one is dealt into
    blocks of that size, one sweep over the texts each, and what matches inside a longer match of another block is taken out
    afterwards. With one automaton nothing but the vocabulary is stored or shuffled. ``packed`` gives (id, phrases), the different
    phrases of a text in one row.
    """
    spark = texts.sparkSession
    plain = F.array_join(words(F.col(phrase_column)), " ")
    vocabulary = pinned(vocabulary.select(plain.alias("phrase")).where("phrase <> ''").distinct())
    size = vocabulary.agg(F.sum(F.octet_length("phrase") + 64)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    rows = texts.select(F.col(id_column).alias("id"), words(F.col(text_column)).alias("words"))
    kind, form = rows.schema["id"].dataType.simpleString(), "packed" if packed else "counts"
    schema = f"id {kind}, phrases array<string>" if packed else f"id {kind}, phrase string, n bigint"
    if blocks > 1:
        rows, form = pinned(rows.withColumn("row", F.monotonically_increasing_id())), "places"
        schema = f"row bigint, id {kind}, phrase string, start bigint, `end` bigint"
    found = None
    for block in range(blocks):
        own = vocabulary.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast(PhraseAutomaton(sorted(r["phrase"] for r in own.collect())))
        part = rows.mapInArrow(lambda batches, shared=shared: _matched(batches, shared, form), schema)
        part = pinned(part) if blocks > 1 else part
        found = part if found is None else found.union(part)
    if blocks > 1:
        # of all blocks: longest first from each start, and nothing that ends by a longer one's end
        later = Window.partitionBy("row").orderBy(F.desc("end"), "start").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("least", F.min("start").over(later)).where("least IS NULL OR start < least")
        if packed:
            found = found.groupBy("row", "id").agg(F.collect_set("phrase").alias("phrases")).drop("row")
        else:
            found = found.groupBy("row", "id", "phrase").agg(F.count(F.lit(1)).alias("n")).drop("row")
    return found.withColumnRenamed("id", id_column)


def _deletions(text: str) -> str:
    """SQL for the texts that miss one character of ``text``."""
    return (
        f"if(length({text}) = 0, cast(array() as array<string>), transform(sequence(1, length({text})), "
        f"i -> concat(left({text}, i - 1), substring({text}, i + 1))))"
    )


def _near_keys(distance: int, probing: bool) -> Column:
    """Keys of a ``name``: names within the distance have one in common, if one side is indexed and the other probing.

    Short names: all texts with up to ``distance`` characters deleted. Long ones: with d edits one of d + 1 even segments of
    the indexed name stays whole; the probing name offers, for each length that is near enough, what stands at the places
    where such a segment can be.
    """
    deleted = f"concat(array(name), {_deletions('name')})"
    for _ in range(distance - 1):
        deleted = f"array_distinct(flatten(transform({deleted}, x -> concat(array(x), {_deletions('x')}))))"
    short = f"transform({deleted}, x -> concat('d:', x))"
    parts, size = distance + 1, "length(name)"
    begin, width = f"(k * n div {parts})", f"((k + 1) * n div {parts} - k * n div {parts})"
    lengths = f"sequence({size} - {distance}, {size} + {distance})" if probing else f"array({size})"
    shifts = f"sequence(-{distance}, {distance})" if probing else "array(0)"
    piece = f"concat_ws(':', 's', n, k, substring(name, 1 + {begin} + s, {width}))"
    segments = f"transform({shifts}, s -> {piece})"
    long = f"flatten(transform({lengths}, n -> flatten(transform(sequence(0, {distance}), k -> {segments}))))"
    none = "cast(array() as array<string>)"
    return F.array_distinct(
        F.concat(
            F.expr(f"if({size} <= {LONG_NAME}, {short}, {none})"),
            F.expr(f"if({size} > {LONG_NAME - distance}, {long}, {none})"),
        )
    )


def normalised(names: DataFrame, vocabulary: DataFrame, name_column: str = "name", skill_column: str = "skill", most: int = 2) -> DataFrame:
    """(name, skill, distance): for every different name the nearest vocabulary name within ``most`` edits, else null.

    An edit inserts, deletes or replaces one character. Of equally near ones the first in order stays. The result is
    complete: distance 0 is a join by equality; then, for the names without a result so far, distance 1, 2, … by shared keys
    and exact distances of what shares one. Null names are left out; the empty name is a name.
    """
    left = pinned(names.select(F.col(name_column).alias("name")).where("name IS NOT NULL").distinct())
    right = pinned(vocabulary.select(F.col(skill_column).alias("name")).where("name IS NOT NULL").distinct())
    found = left.join(right, "name", "left_semi").select("name", F.col("name").alias("skill"), F.lit(0).alias("distance"))
    rest = pinned(left.join(right, "name", "left_anti"))
    for distance in range(1, most + 1):
        index = right.select(F.col("name").alias("skill"), F.explode(_near_keys(distance, False)).alias("key"))
        probes = rest.select("name", F.explode(_near_keys(distance, True)).alias("key"))
        # a pair that shares several keys is one candidate
        pairs = probes.join(index, "key").select("name", "skill").distinct()
        pairs = pairs.withColumn("distance", F.levenshtein("name", "skill")).where(F.col("distance") <= distance)
        best = pinned(pairs.groupBy("name").agg(F.min("skill").alias("skill"), F.min("distance").alias("distance")))
        found = found.union(best)
        rest = rest.join(best, "name", "left_anti")
        rest = pinned(rest) if distance < most else rest
    nothing = rest.select("name", F.lit(None).cast("string").alias("skill"), F.lit(None).cast("int").alias("distance"))
    return found.union(nothing)
