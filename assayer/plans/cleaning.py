"""Clean a list of tables, each on its own, and say what happened."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.functions.relations import small_relation
from assayer.operators.clean import clean_counts, clean_table
from assayer.operators.frequency import union_all
from assayer.sources.discovery import find_file
from assayer.session import pinned
from assayer.sources.loading import TABLE_ERRORS, read_table, reason
from assayer.sources.sinks import refuse_overlap, save_table

RESULT_SCHEMA = {
    "dataset": "string",
    "success": "boolean",
    "original_rows": "bigint",
    "cleaned_rows": "bigint",
    "duplicates_removed": "bigint",
    "saved_path": "string",
    "error": "string",
}


def clean_all(spark: SparkSession, folder: str, names: list[str], target: str, fmt: str = "parquet") -> DataFrame:
    """Find, clean and write each named file. Never raises for a single table.

    Row counts come from the source and from what was written, not from
    counters kept while writing, so a task that runs twice does not change
    them.
    """
    rows = []
    for name in names:
        stem = name.rsplit(".", 1)[0]
        path = f"{target.rstrip('/')}/{name if fmt == 'csv' else stem}"
        try:
            found = find_file(spark, folder, name)
            refuse_overlap(found, path)
            source = read_table(spark, found)
            before = source.count()
            save_table(clean_table(source), path, fmt)
            after = read_back(spark, path, fmt).count()
            rows.append((name, True, before, after, before - after, path, None))
        except TABLE_ERRORS as error:
            rows.append((name, False, None, None, None, None, reason(error)))
    return small_relation(spark, RESULT_SCHEMA, rows)


def read_back(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return spark.read.format(fmt).load(path)


def clean_results(tables: Mapping[str, DataFrame], failures: Mapping[str, str] | None = None) -> DataFrame:
    """The same findings without writing anything: (dataset, success, counts, error)."""
    parts, failed = [], dict(failures or {})
    spark = None
    for name in sorted(tables):
        spark = tables[name].sparkSession
        try:
            # computed here, so that a table that cannot be read fails on its own
            counts = pinned(clean_counts(tables[name]))
        except TABLE_ERRORS as error:
            failed[name] = reason(error)
            continue
        parts.append(
            counts.select(
                F.lit(name).alias("dataset"),
                F.lit(True).alias("success"),
                "original_rows",
                "cleaned_rows",
                "duplicates_removed",
                F.lit(None).cast("string").alias("error"),
            )
        )
    schema = {k: v for k, v in RESULT_SCHEMA.items() if k != "saved_path"}
    if failed:
        parts.append(small_relation(spark, schema, [(n, False, None, None, None, e) for n, e in sorted(failed.items())]))
    return union_all(parts)


def clean_summary(results: DataFrame) -> DataFrame:
    """(succeeded, failed, duplicates_removed, failures)."""
    return results.agg(
        F.count_if("success").alias("succeeded"),
        F.count_if(~F.col("success")).alias("failed"),
        F.coalesce(F.sum("duplicates_removed"), F.lit(0)).alias("duplicates_removed"),
        F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("dataset")))).alias("failures"),
    )
