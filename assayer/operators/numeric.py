"""Moments, quartiles and outliers of numeric columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.config import DEFAULTS, LIMITS, Limits, Thresholds
from assayer.functions.columns import nan_to_null, numeric_columns, numeric_value, ref, share_pct
from assayer.functions.relations import column_list, one_row_per, small_relation
from assayer.functions.types import FLOATING
from assayer.operators.frequency import union_all
from assayer.operators.quantiles import approximate_quantiles, exact_quantiles

# Columns per aggregate: a bound on the size of one generated expression, not on a result.
_CHUNK = 40
_MOMENTS = {"n": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"}
_EXACT = {"min_exact": "string", "max_exact": "string"}


def _chosen(df: DataFrame, columns: list[str] | None) -> list[tuple[int, str]]:
    wanted = set(numeric_columns(df) if columns is None else columns)
    return [(i, c) for i, c in enumerate(df.columns) if c in wanted]


def _flat(df: DataFrame, chosen: list[tuple[int, str]], aggregates: Callable, row: Callable) -> DataFrame:
    """One row per column from plain aggregates over the table as it is, without a long form."""
    parts = []
    for k in range(0, len(chosen), _CHUNK):
        part = chosen[k : k + _CHUNK]
        found = df.agg(*[a for i, c in part for a in aggregates(i, c)])
        parts.append(one_row_per(found, [row(i, c) for i, c in part]))
    return union_all(parts)


def _defined(value: Column) -> Column:
    """Findings have one kind of missing too: what is not a number is null."""
    return F.when(~F.isnan(value), value)


def moments(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(ordinal, n, mean, std, min, max, min_exact, max_exact). std is of the sample, null below two values.

    Minimum and maximum are taken in the type of the column. As doubles they are rounded beyond 2**53, so whole numbers and
    decimals also come as exact text.
    """
    df = nan_to_null(df)
    chosen = _chosen(df, columns)
    if not chosen:
        return small_relation(df.sparkSession, {"ordinal": "int", **_MOMENTS, **_EXACT}, [])
    exact = {i for i, c in chosen if not isinstance(df.schema.fields[i].dataType, FLOATING)}

    def aggregates(i: int, c: str) -> list[Column]:
        v = numeric_value(c)
        return [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(ref(c)).alias(f"min{i}"),
            F.max(ref(c)).alias(f"max{i}"),
        ]

    def row(i: int, c: str) -> Column:
        ends = [F.col(f"{e}{i}") for e in ("min", "max")]
        return F.struct(
            F.lit(i).alias("ordinal"),
            F.col(f"n{i}").alias("n"),
            _defined(F.col(f"mean{i}")).alias("mean"),
            _defined(F.col(f"std{i}")).alias("std"),
            *[e.cast("double").alias(n) for e, n in zip(ends, ("min", "max"))],
            *[(e if i in exact else F.lit(None)).cast("string").alias(n) for e, n in zip(ends, _EXACT)],
        )

    return _flat(df, chosen, aggregates, row)


def _add_quartiles(base: DataFrame, quantiles: DataFrame) -> DataFrame:
    # both sides have one row per column of the table
    parts = quantiles.select(
        "ordinal", *[F.get("quantiles", F.lit(j)).alias(name) for j, name in enumerate(("q1", "median", "q3"))]
    )
    return base.join(F.broadcast(parts), "ordinal", "left")


def numeric_profile(
    df: DataFrame, columns: list[str] | None = None, limits: Limits = LIMITS, approximate: bool = False
) -> DataFrame:
    """(ordinal, column, n, mean, std, min, q1, median, q3, max, min_exact, max_exact), null where there is no value."""
    df = nan_to_null(df)
    chosen = numeric_columns(df) if columns is None else columns
    if not chosen:
        kinds = dict.fromkeys(("mean", "std", "min", "q1", "median", "q3", "max"), "double") | _EXACT
        return small_relation(df.sparkSession, {"ordinal": "int", "column": "string", "n": "bigint", **kinds}, [])
    quantiles = (approximate_quantiles if approximate else exact_quantiles)(df, chosen, limits=limits)
    listed = column_list(df, chosen).select("ordinal", "column")
    joined = listed.join(F.broadcast(_add_quartiles(moments(df, chosen), quantiles)), "ordinal", "left").na.fill(0, ["n"])
    return joined.select("ordinal", "column", "n", "mean", "std", "min", "q1", "median", "q3", "max", *_EXACT)


def iqr_outliers(
    df: DataFrame,
    columns: list[str] | None = None,
    rules: Thresholds = DEFAULTS,
    limits: Limits = LIMITS,
    quantiles: DataFrame | None = None,
) -> DataFrame:
    """(ordinal, column, n, lower, upper, outliers, outlier_pct).

    Strictly outside the fence; no fence, hence no outlier, if the quartiles
    are equal or there is no value. The percentage is of non-null values.
    """
    df = nan_to_null(df)
    chosen = numeric_columns(df) if columns is None else columns
    if not chosen:
        kinds = {"n": "bigint", "lower": "double", "upper": "double", "outliers": "bigint", "outlier_pct": "double"}
        return small_relation(df.sparkSession, {"ordinal": "int", "column": "string", **kinds}, [])
    quantiles = exact_quantiles(df, chosen, limits=limits) if quantiles is None else quantiles
    fences = {}
    for found in quantiles.collect():  # one row per column of the table
        q1, _, q3 = found["quantiles"] or (None, None, None)
        if q1 is not None and q3 is not None and q1 != q3:
            reach = rules.iqr_factor * (q3 - q1)
            fences[found["ordinal"]] = (q1 - reach, q3 + reach)

    def aggregates(i: int, c: str) -> list[Column]:
        v = numeric_value(c)
        outside = (v < fences[i][0]) | (v > fences[i][1]) if i in fences else F.lit(False)
        return [F.count(v).alias(f"n{i}"), F.count_if(outside).alias(f"out{i}")]

    def row(i: int, c: str) -> Column:
        lower, upper = fences.get(i, (None, None))
        return F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(c).alias("column"),
            F.col(f"n{i}").alias("n"),
            F.lit(lower).cast("double").alias("lower"),
            F.lit(upper).cast("double").alias("upper"),
            F.col(f"out{i}").alias("outliers"),
            share_pct(F.col(f"out{i}"), F.col(f"n{i}")).alias("outlier_pct"),
        )

    return _flat(df, _chosen(df, chosen), aggregates, row)
