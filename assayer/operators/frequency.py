"""Counts per column and per value: missing, distinct, most frequent."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField
from pyspark.sql.window import Window

from assayer.config import LIMITS, Limits
from assayer.functions.columns import KEY_BYTES, compact, group_key, key_class, nan_to_null, ref, row_keys, share_pct, text_key
from assayer.functions.relations import column_list, melt, one_row_per, small_relation
from assayer.functions.types import columns_of, is_categorical, storage_label, value_bytes
from assayer.session import pinned

# Bits of a 64-bit word, and how far a number is shifted to tell its word.
_WORD, _WORD_BITS = 64, 6


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def missing_counts(df: DataFrame) -> DataFrame:
    """(ordinal, column, rows, missing, missing_pct): every column in one aggregate, one scan."""
    df = nan_to_null(df)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(ref(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    long = one_row_per(
        counted,
        [
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(c).alias("column"),
                F.col("rows"),
                (F.col("rows") - F.col(f"n{i}")).alias("missing"),
            )
            for i, c in enumerate(df.columns)
        ],
    )
    return long.withColumn("missing_pct", share_pct(F.col("missing"), F.col("rows")))


def _key_counts(parts: list[tuple[DataFrame, dict[int, StructField]]]) -> DataFrame:
    """(ordinal, missing, n_nonnull, n_unique), exact, for columns of one or many tables.

    Columns are melted per key class, so that a number is grouped as a number
    and each scan reads only the columns of its class; tables share the
    aggregate of a class. The aggregate on (ordinal, value) combines before
    the shuffle: a value that holds a third of the rows is one row per map
    task. Whole numbers are marked as bits, 64 neighbours in one row, so that
    a dense key needs a small part of its values in memory and shuffle.
    """
    classes: dict[str, list[DataFrame]] = {}
    for df, fields in parts:
        of_class: dict[str, dict[int, Column]] = {}
        for i, f in fields.items():
            of_class.setdefault(key_class(f.dataType), {})[i] = group_key(ref(f.name), f.dataType)
        for cls, values in of_class.items():
            classes.setdefault(cls, []).append(melt(df, values))
    counted = []
    for cls, melted in classes.items():
        values = union_all(melted)
        if cls == "bigint":
            mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("value").bitwiseAND(_WORD - 1).cast("int"))
            words = values.groupBy("ordinal", F.shiftright("value", _WORD_BITS).alias("value"))
            groups = words.agg(F.count(F.lit(1)).alias("n"), F.bit_or(mark).alias("marks"))
            distinct = F.coalesce(F.sum(F.bit_count("marks")), F.lit(0))
        else:
            groups = values.groupBy("ordinal", "value").agg(F.count(F.lit(1)).alias("n"))
            distinct = F.count("value")
        counted.append(
            groups.groupBy("ordinal").agg(
                F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
                F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n_nonnull"),
                distinct.alias("n_unique"),
            )
        )
    return union_all(counted)


_STATS = ("rows", "missing", "missing_pct", "n_nonnull", "n_unique")


def tables_stats(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]] | None = None) -> DataFrame:
    """(dataset, ordinal, column, dtype, rows, missing, missing_pct, n_nonnull, n_unique) of many tables."""
    parts, listed = [], []
    for name in sorted(tables):
        df = nan_to_null(tables[name])
        chosen = set(df.columns if columns is None else columns.get(name, []))
        fields = {}
        for i, f in enumerate(df.schema.fields):
            if f.name in chosen:
                fields[len(listed)] = f
                listed.append((len(listed), name, i, f.name, f.dataType.simpleString()))
        parts.append((df, fields))
    schema = {"place": "int", "dataset": "string", "ordinal": "int", "column": "string", "dtype": "string"}
    names = small_relation(next(iter(tables.values())).sparkSession, schema, listed)
    if listed:
        # the counts are one row per column
        counts = _key_counts([p for p in parts if p[1]]).withColumnRenamed("ordinal", "place")
        counted = names.join(F.broadcast(counts), "place", "left").na.fill(0, ["missing", "n_nonnull", "n_unique"])
    else:
        counted = names.withColumns({c: F.lit(0).cast("bigint") for c in ("missing", "n_nonnull", "n_unique")})
    counted = counted.withColumn("rows", F.col("missing") + F.col("n_nonnull"))
    return counted.withColumn("missing_pct", share_pct(F.col("missing"), F.col("rows"))).select(
        "dataset", "ordinal", "column", "dtype", *_STATS
    )


def row_count(df: DataFrame, known: int | None = None) -> DataFrame:
    """(rows): counted, unless the number is known already."""
    if known is not None:
        return small_relation(df.sparkSession, {"rows": "bigint"}, [(known,)])
    return df.agg(F.count(F.lit(1)).alias("rows"))


def column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The base findings of every column, from which most rules follow.

    (ordinal, column, dtype, rows, missing, missing_pct, n_nonnull, n_unique)
    """
    return tables_stats({"": df}, None if columns is None else {"": columns}).drop("dataset")


def labelled(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the storage label, which depends on whether the column has a gap."""
    rows = [
        (i, storage_label(f.dataType, False), storage_label(f.dataType, True)) for i, f in enumerate(df.schema.fields)
    ]
    names = small_relation(df.sparkSession, {"ordinal": "int", "full": "string", "gapped": "string"}, rows)
    return (
        stats.join(F.broadcast(names), "ordinal")
        .withColumn("label", F.when(F.col("missing") > 0, F.col("gapped")).otherwise(F.col("full")))
        .drop("full", "gapped")
    )


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """(ordinal, column, n_unique): exact unless asked otherwise; nulls do not count."""
    if not approximate:
        return column_stats(df, columns).select("ordinal", "column", "n_unique")
    df = nan_to_null(df)
    names = df.columns if columns is None else columns
    fields = [(i, f) for i, f in enumerate(df.schema.fields) if f.name in set(names)]
    counted = df.agg(
        *[F.approx_count_distinct(group_key(ref(f.name), f.dataType)).alias(f"n{i}") for i, f in fields]
    )
    return one_row_per(
        counted,
        [
            F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"), F.col(f"n{i}").alias("n_unique"))
            for i, f in fields
        ],
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """(rows, distinct_rows, duplicate_rows) over full rows, nulls equal.

    Long texts travel as digests. Copies collapse before the shuffle.
    """
    keys = row_keys(nan_to_null(df))
    groups = nan_to_null(df).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicate_rows", F.col("rows") - F.col("distinct_rows"))


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(ordinal, key, long, n) of non-null values. The key is the value itself, or a digest if the value is long."""
    df = nan_to_null(df)
    chosen = set(columns_of(df.schema, is_categorical) if columns is None else columns)
    values = {
        i: text_key(ref(f.name), f.dataType) for i, f in enumerate(df.schema.fields) if f.name in chosen
    }
    return (
        melt(df, values)
        .where(F.col("value").isNotNull())
        .groupBy("ordinal", compact(F.col("value")).alias("key"), (F.octet_length("value") > KEY_BYTES).alias("long"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_values(
    df: DataFrame, limit: int, columns: list[str] | None = None, limits: Limits = LIMITS
) -> DataFrame:
    """(ordinal, column, value, n, rank): the ``limit`` most frequent values per column.

    Order: n descending, then value ascending. How often each count occurs
    tells the count at which the limit falls. Fewer than ``limit`` values lie
    above it; of those at it, every task passes on its ``limit`` smallest at
    most. A long text is looked up by its digest only if it can be among
    them, so texts are never shuffled for counting.
    """
    df = nan_to_null(df)
    chosen = columns_of(df.schema, is_categorical) if columns is None else list(columns)
    if not chosen:
        return small_relation(
            df.sparkSession,
            {"ordinal": "int", "column": "string", "value": "string", "n": "bigint", "rank": "int"},
            [],
        )
    counts = pinned(value_counts(df, chosen))
    # one row per column and count, of which there are few: k different counts need k * k / 2 rows
    more = Window.partitionBy("ordinal").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    often = counts.groupBy("ordinal", "n").agg(F.count(F.lit(1)).alias("values"))
    above = often.withColumn("above", F.coalesce(F.sum("values").over(more), F.lit(0))).where(F.col("above") < limit)
    cut = above.groupBy("ordinal").agg(F.min("n").alias("least"))
    candidates = counts.join(F.broadcast(cut), "ordinal").where(F.col("n") >= F.col("least")).drop("least")
    by_value = Window.partitionBy("ordinal").orderBy(F.desc("n"), F.asc("value"))

    def first(values: DataFrame) -> DataFrame:
        """At most ``limit`` per column; the limit also holds in every task before the shuffle."""
        return values.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= limit)

    found = first(candidates.where(~F.col("long")).select("ordinal", F.col("key").alias("value"), "n"))
    digested = candidates.where("long").select("ordinal", "key", "n")
    in_columns = {row["ordinal"]: row["n"] for row in digested.groupBy("ordinal").agg(F.count("n").alias("n")).collect()}
    if in_columns:
        # usually a handful; ties can make it long
        few = sum(in_columns.values()) * 2 * KEY_BYTES <= limits.broadcast_bytes
        values = {
            i: text_key(ref(f.name), f.dataType) for i, f in enumerate(df.schema.fields) if i in in_columns
        }
        looked_up = (
            melt(df, values)
            .where(F.octet_length("value") > KEY_BYTES)
            .withColumn("key", compact(F.col("value")))
            .join(F.broadcast(digested) if few else digested, ["ordinal", "key"])
            .groupBy("ordinal", "key", "n")
            .agg(F.first("value").alias("value"))
        )
        found = found.unionByName(first(looked_up.select("ordinal", "value", "n")))
    return (
        first(found.select("ordinal", "value", "n"))
        .join(F.broadcast(column_list(df, chosen).select("ordinal", "column")), "ordinal")
        .select("ordinal", "column", "value", "n", "rank")
    )


def logical_size(df: DataFrame) -> DataFrame:
    """(rows, bytes): widths of fixed types times rows, plus the length of every text."""
    fixed, measured = 0, []
    for field in df.schema.fields:
        width = value_bytes(field.dataType)
        if width is not None:
            fixed += width
        else:
            measured.append(F.coalesce(F.sum(F.octet_length(text_key(ref(field.name), field.dataType))), F.lit(0)))
    rows = F.count(F.lit(1))
    total = reduce(lambda a, b: a + b, measured, rows * F.lit(fixed))
    return df.agg(rows.alias("rows"), total.cast("bigint").alias("bytes"))
