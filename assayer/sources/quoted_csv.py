"""Records of CSV files whose quoted values span lines, read by many tasks.

Whether a line begins inside a quoted value depends on everything before it. A line maps either state (outside, inside) to
one of them, and so does a split of a file, so one scan finds the maps of all splits, a running window over the splits tells
the state in which each begins, and a second scan cuts every split into records on its own. Only a record that crosses the
end of a split is put together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assayer.session import pinned

BROADCAST_SPLITS = 50_000  # rows of a path and three numbers

# A value is quoted if its first character is a quote. A quote that is not doubled ends it, whatever follows up to the comma.
_OPEN = re.compile(rb'(?:(?:"(?:[^"]|"")*+"[^,]*+|[^",][^,]*+|),)*+"(?:[^"]|"")*+\Z')
_REST = re.compile(rb'(?:[^"]|"")*+')
_TO_COMMA = re.compile(rb'"[^,]*+,?')

_SPLIT = ["file", "block", "length"]


def ends_inside(line: bytes, inside: bool) -> bool:
    """Whether a quoted value is open at the end of a line that begins outside, or inside, such a value."""
    if b'"' not in line:
        return inside
    start = 0
    if inside:
        start = _REST.match(line).end()
        if start == len(line):
            return True
        start = _TO_COMMA.match(line, start).end()
        if line[start - 1 : start] != b",":
            return False
    return _OPEN.match(line, start) is not None


def _lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """(file, block, length, number, line): every line with the split that it begins in; ``number`` follows their order."""
    at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("_metadata.file_block_length")
    read = spark.read.option("lineSep", "\n").text(files)
    named = [c.alias(name) for c, name in zip(at, _SPLIT, strict=True)]
    return read.select(*named, F.monotonically_increasing_id().alias("number"), F.col("value").cast("binary").alias("line"))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: where both states lead, whether a line holds a carriage return that does not end it, and whether
    the first line of the file ends with one."""
    split, after, lone, ended, rows = None, [False, True], False, False, []
    for batch in batches:
        places = zip(*(batch.column(c).to_pylist() for c in _SPLIT), strict=True)
        for place, line in zip(places, batch.column("line").to_pylist(), strict=True):
            if place != split:
                if split:
                    rows.append((*split, *after, lone, ended))
                split, after, lone = place, [False, True], False
                ended = place[1] == 0 and line.endswith(b"\r")
            if b'"' in line:
                after = [ends_inside(line, s) for s in after]
            lone = lone or b"\r" in line[:-1]
    if split:
        rows.append((*split, *after, lone, ended))
    names = [*_SPLIT, "from_outside", "from_inside", "lone", "returns"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def begins_inside() -> Column:
    """The state before a split, over the splits of its file: what the last one that forgets its state left, turned by each
    split since then that swaps the two."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    to = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swaps = F.when(F.col("from_outside") & ~F.col("from_inside"), 1).otherwise(0)
    fixed = F.col("from_outside") == F.col("from_inside")
    left = F.last(F.when(fixed, F.col("from_outside").cast("int") + F.sum(swaps).over(to)), ignorenulls=True)
    return F.struct(left.over(before).alias("left"), F.sum(swaps).over(before).alias("swaps"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records: (file, block, kind, first, returns, text).

    ``kind`` 0 is a whole record, 1 a piece that goes on with a record of an earlier split, 2 one that begins a record.
    ``first`` marks what the first record of a file begins with.
    """
    names = ["file", "block", "kind", "first", "returns", "text"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    split, held, inside, earlier, first, returns, rows = None, [], False, False, False, False, []

    def give(kind: int) -> None:
        nonlocal held, first
        text = b"\n".join(held)
        held = []
        if kind or text not in (b"", b"\r"):
            rows.append((split[0], split[1], kind, first, returns, text))
            first = False

    for batch in batches:
        places = zip(*(batch.column(c).to_pylist() for c in _SPLIT), strict=True)
        rest = (batch.column(c).to_pylist() for c in ("inside", "returns", "line"))
        for place, begin, ends, line in zip(places, *rest, strict=True):
            if place != split:
                if held:
                    give(1 if earlier else 2)
                split, inside, earlier, first, returns = place, begin, begin, place[1] == 0, ends
            held.append(line)
            inside = ends_inside(line, inside)
            if not inside:
                give(1 if earlier else 0)
                earlier = False
        columns = list(zip(*rows, strict=True)) or [[] for _ in names]
        rows = []
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)
    if held:
        give(1 if earlier else 2)
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)


def quoted_records(spark: SparkSession, files: str | list[str], encoding: str) -> DataFrame | None:
    """(record): the text of every record after the header, with its quotes and inner line ends.

    None where a file has carriage returns inside its lines: what ends a line there is for the whole file to tell. Records
    without any text are left out. A quote that is never closed holds the rest of its file, but for
    the last line end.
    """
    lines = _lines(spark, files)
    schema = "file string, block bigint, length bigint, from_outside boolean, from_inside boolean, lone boolean, returns boolean"
    maps = pinned(lines.select(*_SPLIT, "line").mapInArrow(_maps, schema))
    seen = maps.agg(F.count(F.lit(1)).alias("splits"), F.max("lone").alias("lone")).first()
    if seen["lone"]:
        return None
    state = F.col("state")
    odd = (F.coalesce(state["swaps"], F.lit(0)) + F.coalesce(state["left"], F.lit(0))) % 2 == 1
    of_file = F.max("returns").over(Window.partitionBy("file")).alias("returns")
    splits = maps.withColumn("state", begins_inside()).select(*_SPLIT, odd.alias("inside"), of_file)
    small = seen["splits"] <= BROADCAST_SPLITS
    placed = lines.join(F.broadcast(splits) if small else splits, _SPLIT, "left")
    if not small:
        placed = placed.repartition("file", "block").sortWithinPartitions("file", "block", "number")
    # both scans must see the same splits, also where the cluster changed between them
    changed = F.raise_error(F.lit("the splits of the file changed between two scans")).cast("boolean")
    placed = placed.select(*_SPLIT, F.coalesce("inside", changed).alias("inside"), "returns", "line")
    pieces = pinned(placed.mapInArrow(_cut, "file string, block bigint, kind int, first boolean, returns boolean, text binary"))
    whole = pieces.where("kind = 0").select("first", "returns", "text")
    # at most two pieces a split; the record that a piece belongs to began in the last split before it that begins one
    of_file = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    crossing = pieces.where("kind > 0").withColumn("began", F.last(F.when(F.col("kind") == 2, F.col("block")), True).over(of_file))
    gathered = F.array_sort(F.collect_list(F.struct("block", "first", "returns", F.hex("text").alias("text"))))
    joined = crossing.groupBy("file", "began").agg(gathered.alias("parts")).select(
        *[F.get("parts", F.lit(0))[c].alias(c) for c in ("first", "returns")],
        F.unhex(F.array_join(F.transform("parts", lambda p: p["text"]), "0A")).alias("text"),
    )
    records = whole.unionByName(joined).where(~F.col("first"))
    text = F.regexp_replace(F.decode("text", encoding), r"\r\z", "")
    # in a file whose lines end with both characters, so do the lines inside a value, which has the second one alone
    return records.select(F.when(F.col("returns"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text).alias("record"))
