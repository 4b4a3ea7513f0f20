"""Inspect many tables: shape, types, missing values, duplicate rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.relations import small_relation
from assayer.operators.frequency import duplicate_rows, labelled, missing_counts, union_all
from assayer.session import pinned
from assayer.sources.loading import TABLE_ERRORS, reason

DATASET_SCHEMA = {
    "dataset": "string",
    "rows": "bigint",
    "columns": "int",
    "duplicate_rows": "bigint",
    "error": "string",
}


def inspect_columns(df: DataFrame) -> DataFrame:
    """(ordinal, column, label, missing): schema with missing counts, from one aggregate."""
    return labelled(df, missing_counts(df)).select("ordinal", "column", "label", "missing", "missing_pct")


def inspect_datasets(
    spark: SparkSession, tables: Mapping[str, DataFrame], failures: Mapping[str, str] | None = None
) -> DataFrame:
    """One row per table, unreadable ones included with their error."""
    parts, failed = [], dict(failures or {})
    for name in sorted(tables):
        try:
            # computed here, so that a table that cannot be read fails on its own
            counts = pinned(duplicate_rows(tables[name]))
        except TABLE_ERRORS as error:
            failed[name] = reason(error)
            continue
        parts.append(
            counts.select(
                F.lit(name).alias("dataset"),
                "rows",
                F.lit(len(tables[name].columns)).alias("columns"),
                "duplicate_rows",
                F.lit(None).cast("string").alias("error"),
            )
        )
    rows = [(name, None, None, None, text) for name, text in sorted(failed.items())]
    return union_all([*parts, small_relation(spark, DATASET_SCHEMA, rows)])


def inspect_all_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(dataset, ordinal, column, label, missing, missing_pct) over all tables."""
    return union_all(
        [inspect_columns(tables[name]).select(F.lit(name).alias("dataset"), "*") for name in sorted(tables)]
    )
