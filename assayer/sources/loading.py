"""Load tables so that a failing one does not stop the others."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from assayer.functions.columns import nan_to_null
from assayer.functions.relations import small_relation
from assayer.sources.csv import read_csv

# What a table that cannot be read raises; a job that fails while reading raises the second kind.
TABLE_ERRORS = (PySparkException, Py4JJavaError, OSError, ValueError)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV or Parquet by suffix, with one kind of missing value."""
    if path.rstrip("/").lower().endswith(".csv"):
        return read_csv(spark, path)
    return nan_to_null(spark.read.parquet(path))


def load_tables(spark: SparkSession, paths: Mapping[str, str]) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(tables, failures): the readable tables by name, and why the others are not."""
    tables, failures = {}, {}
    for name in sorted(paths):
        try:
            tables[name] = read_table(spark, paths[name])
        except TABLE_ERRORS as error:
            failures[name] = reason(error)
    return tables, failures


def reason(error: Exception) -> str:
    """First line of an error, for a findings row."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    if isinstance(error, Py4JJavaError):
        return f"{type(error).__name__}: {_cause(error)}"
    text = str(error).strip().splitlines()
    if condition == "USER_RAISED_EXCEPTION":
        return text[0]
    return condition or (text[0] if text else type(error).__name__)


def _cause(error: Py4JJavaError) -> str:
    """The innermost message of a failed job."""
    cause = error.java_exception
    while cause.getCause() is not None:
        cause = cause.getCause()
    message = (cause.getMessage() or cause.getClass().getName()).strip().splitlines()
    return message[0] if message else cause.getClass().getName()


def failure_rows(spark: SparkSession, failures: Mapping[str, str]) -> DataFrame:
    return small_relation(spark, {"dataset": "string", "error": "string"}, sorted(failures.items()))
