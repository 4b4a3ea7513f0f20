"""Positions in a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayer.session import pinned

_PART_BITS = 33  # how Spark builds increasing ids: the task above, the row within it below


def placed(rows: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """The rows with their positions 0, 1, … in the given order, stored.

    One range sort; what reaches the driver is one count for each of its tasks. Rows that the order cannot tell apart get
    their positions in any order.
    """
    sorted_rows = pinned(rows.orderBy(*order).withColumn(name, F.monotonically_increasing_id()))
    begins = _begins(sorted_rows, F.shiftright(name, _PART_BITS), F.count(F.lit(1)))
    found = sorted_rows.withColumn("part_", F.shiftright(name, _PART_BITS)).join(F.broadcast(begins), "part_")
    position = F.col("before_") + F.col(name).bitwiseAND((1 << _PART_BITS) - 1)
    return found.withColumn(name, position).drop("part_", "before_")


def shares_up_to(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(value, ``name``): for each distinct value, the share of the rows that are not above it. Nulls are left out."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n_"))
    ordered = pinned(counts.orderBy(value).withColumn("row_", F.monotonically_increasing_id()))
    part = F.shiftright("row_", _PART_BITS)
    begins = _begins(ordered, part, F.sum("n_"))
    whole = begins.agg(F.max("whole_")).first()[0] or 1
    running = F.sum("n_").over(Window.partitionBy("part_").orderBy("row_"))
    found = ordered.withColumn("part_", part).join(F.broadcast(begins), "part_")
    return found.select(value, ((F.col("before_") + running) / F.lit(whole)).alias(name))


def _begins(rows: DataFrame, part: Column, amount: Column) -> DataFrame:
    """(part_, before_, whole_): what the tasks before each one hold, and what all of them do."""
    sizes = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).agg(amount.alias("n")).collect())
    found, before = [], 0
    for number, n in sizes:
        found.append((number, before))
        before += n
    schema = "part_ bigint, before_ bigint, whole_ bigint"
    return rows.sparkSession.createDataFrame([(*f, before) for f in found], schema)
