"""Profile and exploration of one or many tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.config import DEFAULTS, LIMITS, Limits, Thresholds
from assayer.functions.columns import nan_to_null
from assayer.functions.types import columns_of, is_categorical, is_numeric
from assayer.operators.correlation import correlations, strongest
from assayer.operators.frequency import column_stats, duplicate_rows, labelled, logical_size, top_values
from assayer.operators.numeric import iqr_outliers, moments, numeric_profile
from assayer.operators.quality import (
    column_facts,
    column_roles,
    duplicate_columns,
    observations,
    quality_findings,
    recommendations,
)
from assayer.operators.quantiles import exact_quantiles
from assayer.session import pinned, together
from assayer.sources.loading import TABLE_ERRORS, reason

# How many tables are explored at the same time; a bound on threads and on jobs in the driver.
_TABLES_AT_ONCE = 4


def column_profile(df: DataFrame, rules: Thresholds = DEFAULTS, limits: Limits = LIMITS) -> DataFrame:
    """One row per column: type, missing, distinct, then numbers or the most frequent values.

    Percentages are rounded to 2 digits and numbers to 4, half to even.
    """
    df = nan_to_null(df)
    stats = labelled(df, column_stats(df))
    numeric = numeric_profile(df, limits=limits).drop("column", "n")
    other = columns_of(df.schema, lambda dtype: not is_numeric(dtype))
    top = (
        top_values(df, rules.profile_top, other, limits)
        .groupBy("ordinal")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("found"))
        .select("ordinal", F.transform("found", lambda v: F.struct(v["value"], v["n"])).alias("top_values"))
    )
    # all sides are one row per column of the table
    joined = stats.join(F.broadcast(numeric), "ordinal", "left").join(F.broadcast(top), "ordinal", "left")
    rounded = [F.bround(c, 4).alias(c) for c in ("min", "max", "mean", "median", "std")]
    return joined.select(
        "ordinal",
        "column",
        "label",
        "missing",
        F.bround("missing_pct", 2).alias("missing_pct"),
        "n_unique",
        *rounded,
        "min_exact",
        "max_exact",
        "top_values",
    )


def overview(df: DataFrame) -> DataFrame:
    """(rows, columns, bytes, duplicate_rows)."""
    size = logical_size(df).withColumn("columns", F.lit(len(df.columns)))
    copies = duplicate_rows(df).select("rows", "duplicate_rows")
    # one row each, and both count the same rows
    return size.join(F.broadcast(copies), "rows", "left").select("rows", "columns", "bytes", "duplicate_rows")


def categorical_describe(df: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """(ordinal, column, count, unique, top, freq) of categorical columns; ties by value."""
    chosen = columns_of(df.schema, is_categorical)
    stats = column_stats(df, chosen).select("ordinal", "column", F.col("n_nonnull").alias("count"), F.col("n_unique").alias("unique"))
    top = top_values(df, 1, chosen, limits).select("ordinal", F.col("value").alias("top"), F.col("n").alias("freq"))
    return stats.join(F.broadcast(top), "ordinal", "left")


def explore(
    df: DataFrame, rules: Thresholds = DEFAULTS, limits: Limits = LIMITS
) -> dict[str, DataFrame]:
    """All findings about one table, by section.

    The findings that several sections read are computed once and pinned;
    they are a few rows per column. Those that do not need each other are
    computed at the same time.
    """
    df = nan_to_null(df)

    def of_columns() -> tuple[DataFrame, DataFrame]:
        duplicates = duplicate_columns(df)
        return duplicates, pinned(column_facts(df, rules, duplicates))

    def of_numbers() -> tuple[DataFrame, DataFrame]:
        quantiles = pinned(exact_quantiles(df, limits=limits))
        return quantiles, pinned(iqr_outliers(df, rules=rules, limits=limits, quantiles=quantiles))

    (duplicates, facts), (quantiles, outliers), pairs, top, whole = together(
        df.sparkSession,
        of_columns,
        of_numbers,
        lambda: pinned(correlations(df, limits=limits)),
        lambda: top_values(df, rules.explore_top, limits=limits),
        lambda: pinned(overview(df)),
    )
    base = facts.select("ordinal", "column", "label", "rows", "missing", "missing_pct", "n_unique")
    numbers = numeric_section(df, rules, limits, quantiles, outliers)
    return {
        "overview": whole,
        "columns": base,
        "numeric": numbers,
        "correlation": pairs,
        "high_correlation": strongest(pairs, rules),
        "top_values": top,
        "quality": quality_findings(facts, duplicates),
        "roles": column_roles(facts),
        "observations": observations(facts, duplicates, pairs, outliers, rules),
        "recommendations": recommendations(facts),
    }


def numeric_section(
    df: DataFrame,
    rules: Thresholds = DEFAULTS,
    limits: Limits = LIMITS,
    quantiles: DataFrame | None = None,
    outliers: DataFrame | None = None,
) -> DataFrame:
    """(ordinal, column, n, mean, std, min, q1, median, q3, max, outliers, outlier_pct)."""
    df = nan_to_null(df)
    if not columns_of(df.schema, is_numeric):
        return iqr_outliers(df)
    quantiles = pinned(exact_quantiles(df, limits=limits)) if quantiles is None else quantiles
    outliers = iqr_outliers(df, rules=rules, limits=limits, quantiles=quantiles) if outliers is None else outliers
    quartiles = quantiles.select(
        "ordinal", *[F.get("quantiles", F.lit(j)).alias(c) for j, c in enumerate(("q1", "median", "q3"))]
    )
    return (
        outliers.join(F.broadcast(moments(df).drop("n", "min_exact", "max_exact")), "ordinal", "left")
        .join(F.broadcast(quartiles), "ordinal", "left")
        .select("ordinal", "column", "n", "mean", "std", "min", "q1", "median", "q3", "max", "outliers", "outlier_pct")
    )


def explore_all(
    tables: Mapping[str, DataFrame], rules: Thresholds = DEFAULTS, limits: Limits = LIMITS
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(sections over all tables with a dataset column, failures by table)."""
    gathered: dict[str, list[DataFrame]] = {}
    failures: dict[str, str] = {}

    def explored(name: str) -> dict[str, DataFrame] | str:
        try:
            # computed here, so that a table that cannot be read fails on its own
            found = explore(tables[name], rules, limits)
            return dict(zip(found, together(tables[name].sparkSession, *[partial(pinned, part) for part in found.values()])))
        except TABLE_ERRORS as error:
            return reason(error)

    names = sorted(tables)
    steps = [partial(explored, name) for name in names]
    for name, found in zip(names, together(tables[names[0]].sparkSession, *steps, at_once=_TABLES_AT_ONCE) if names else []):
        if isinstance(found, str):
            failures[name] = found
            continue
        for section, findings in found.items():
            gathered.setdefault(section, []).append(findings.select(F.lit(name).alias("dataset"), "*"))
    return {s: _stack(parts) for s, parts in gathered.items()}, failures


def _stack(parts: list[DataFrame]) -> DataFrame:
    """Union by name; a table without numbers has a shorter numeric section."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
