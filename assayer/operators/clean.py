"""Header, text and row cleaning."""

from __future__ import annotations

import operator
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.functions.columns import is_blank, nan_to_null, ref, row_keys, strip
from assayer.functions.types import columns_of, is_text


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names stripped and in lower case.

    Two names that become equal cannot be told apart afterwards, so they are
    an error that names them.
    """
    names = [c.strip().lower() for c in df.columns]
    seen = Counter(names)
    clashes = [c for c, n in zip(df.columns, names) if seen[n] > 1]
    if clashes:
        raise ValueError(f"columns equal after header normalisation: {clashes}")
    return df.toDF(*names)


def strip_strings(df: DataFrame) -> DataFrame:
    """Trim Unicode white space in every text column; null stays null, all-blank becomes ''."""
    texts = columns_of(df.schema, is_text)
    return df.withColumns({c: strip(ref(c)) for c in texts}) if texts else df


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows, nulls equal. Copies collapse before the shuffle."""
    df = nan_to_null(df)
    if not any("map<" in f.dataType.simpleString() for f in df.schema.fields):
        return df.dropDuplicates()
    # maps cannot be compared as they are; their rows are told apart by keys
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    keys = [f"k{i}" for i in range(len(df.columns))]
    return plain.select("*", *row_keys(plain)).dropDuplicates(keys).drop(*keys).toDF(*df.columns)


def clean_table(df: DataFrame) -> DataFrame:
    """Headers, then texts, then duplicates: trimming first makes more rows equal."""
    return drop_duplicate_rows(strip_strings(normalize_headers(df)))


def clean_counts(df: DataFrame) -> DataFrame:
    """(original_rows, cleaned_rows, duplicates_removed) of ``clean_table`` without building it."""
    trimmed = nan_to_null(strip_strings(normalize_headers(df)))
    groups = trimmed.groupBy(*row_keys(trimmed)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("original_rows"), F.count(F.lit(1)).alias("cleaned_rows")
    ).withColumn("duplicates_removed", F.col("original_rows") - F.col("cleaned_rows"))


def clean_text_rows(df: DataFrame, text_column: str) -> DataFrame:
    """Drop duplicates, then rows whose text is null or blank. Without the column only the first."""
    unique = drop_duplicate_rows(df)
    return unique.where(~is_blank(ref(text_column))) if text_column in df.columns else unique


def clean_text_counts(df: DataFrame, text_column: str) -> DataFrame:
    """(rows_before, duplicates_removed, empty_text_removed, rows_after); duplicates are counted first."""
    df = nan_to_null(df)
    blank = is_blank(ref(text_column)) if text_column in df.columns else F.lit(False)
    groups = df.groupBy(*row_keys(df), blank.alias("blank")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(F.col("blank")).alias("empty_text_removed"),
        F.count_if(~F.col("blank")).alias("rows_after"),
    )


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without a missing value in ``columns``."""
    df = nan_to_null(df)
    return df.where(reduce(operator.and_, [ref(c).isNotNull() for c in columns], F.lit(True)))
