"""Small helpers of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.session import pinned

ROW_KEY = "assayer_row_key"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RANK_PARTS = 1024
BROADCAST_ROWS = 1_000_000  # rows of a few numbers each


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the given names. Any others, whatever they are called, are left out."""
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(name)}").alias(alias) for alias, name in columns.items()])


def lower_az(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, LETTERS, LETTERS.lower()))


def ranked(rows: DataFrame, group: str, spread: list[str], order: list[str]) -> DataFrame:
    """Adds ``rank``: 0, 1, … within each group, by parts of the group and ``order`` within a part.

    A group of any size is dealt by the hash of the ``spread`` columns into ``RANK_PARTS`` parts that are ranked apart; a
    part's first rank follows from the counts of the parts before it. ``rows`` should be a stored table: it is read twice.
    Rows that ``order`` cannot tell apart get their ranks in any order.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(7), *spread), F.lit(RANK_PARTS)))
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy(group, "part").orderBy(*order)
    joined = dealt.join(first, [group, "part"])
    return joined.withColumn("rank", F.col("first") + F.row_number().over(within) - 1).drop("part", "first")


def narrow(stored: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, broadcast where a count shows that it is small enough, else as it is."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def row_keyed(df: DataFrame) -> DataFrame:
    """The rows with a key of their own in the column ``ROW_KEY``, the same whenever and wherever they are read.

    Rows of stored files are known by their file and their place in it; any others are stored first. Columns may have any
    names but that of the key.
    """
    plan = df._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if plan != "LogicalRelation" or not len(df._jdf.inputFiles()):
        return pinned(df.withColumn(ROW_KEY, F.monotonically_increasing_id()))
    names = [f"c{i}" for i in range(len(df.columns))]
    own = df.metadataColumn("_metadata")
    rows = df.select("*", own["file_path"], own["row_index"]).toDF(*names, "path", "place")
    files = rows.select("path").distinct()
    files = pinned(files.withColumn("file", F.row_number().over(Window.orderBy("path")).cast("bigint")))
    key = F.shiftleft("file", 40).bitwiseOR(F.col("place"))
    keyed = rows.join(narrow(files), "path").select(*names, key.alias(ROW_KEY))
    return keyed.toDF(*df.columns, ROW_KEY)
