"""Small relations made from names and schemas, never from rows."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ARROW = {
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "array<string>": pa.list_(pa.string()),
}


def small_relation(spark: SparkSession, schema: dict[str, str], rows: Iterable[tuple]) -> DataFrame:
    """A local relation; Spark knows its size and plans joins with it accordingly."""
    rows = list(rows)
    arrays = [pa.array([row[i] for row in rows], type=_ARROW[t]) for i, t in enumerate(schema.values())]
    table = pa.Table.from_arrays(arrays, names=list(schema))
    return spark.createDataFrame(table)


def column_list(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(ordinal, column, dtype) of the chosen columns."""
    chosen = set(df.columns if columns is None else columns)
    rows = [
        (i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields) if f.name in chosen
    ]
    return small_relation(df.sparkSession, {"ordinal": "int", "column": "string", "dtype": "string"}, rows)


def one_row_per(aggregated: DataFrame, structs: list[Column]) -> DataFrame:
    """Turn the one row of a global aggregate into one row per struct."""
    return aggregated.select(F.inline(F.array(*structs)))


def melt(df: DataFrame, values: dict[int, Column]) -> DataFrame:
    """Long form (ordinal, value); all values must have one type."""
    wide = df.select([v.alias(str(i)) for i, v in values.items()])
    return wide.unpivot([], list(wide.columns), "ordinal", "value").select(
        F.col("ordinal").cast("int").alias("ordinal"), "value"
    )
