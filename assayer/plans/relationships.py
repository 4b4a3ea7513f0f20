"""Keys, shared columns and links over a collection of tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.config import DEFAULTS, Thresholds
from assayer.functions.relations import small_relation
from assayer.functions.types import dtype_family
from assayer.operators.frequency import row_count, tables_stats, union_all
from assayer.operators.keys import table_keys
from assayer.operators.relations import (
    contributions,
    foreign_keys,
    matching_columns,
    merge_guidance,
    relationship_summary,
    standalone_tables,
)
from assayer.session import pinned
from assayer.sources.loading import TABLE_ERRORS, reason


def dataset_overview(
    tables: Mapping[str, DataFrame],
    keys: DataFrame,
    rules: Thresholds = DEFAULTS,
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """(dataset, rows, columns, type_mix, keys): composite keys are cut to the first few. ``counts``: rows, if known."""
    parts = []
    for name in sorted(tables):
        df = tables[name]
        families: dict[str, int] = {}
        for f in df.schema.fields:
            families[dtype_family(f.dataType)] = families.get(dtype_family(f.dataType), 0) + 1
        mix = ", ".join(f"{k}={families[k]}" for k in sorted(families))
        parts.append(
            row_count(df, (counts or {}).get(name)).select(
                F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"), F.lit(mix).alias("type_mix")
            )
        )
    single = F.array_sort(F.collect_list(F.when(F.col("kind") == "single", F.array_join("columns", " + "))))
    double = F.array_sort(F.collect_list(F.when(F.col("kind") == "composite", F.array_join("columns", " + "))))
    listed = keys.groupBy("dataset").agg(F.concat(single, F.slice(double, 1, rules.composite_listed)).alias("keys"))
    # keys are one row per table
    return (
        union_all(parts)
        .join(F.broadcast(listed), "dataset", "left")
        .withColumn("keys", F.coalesce("keys", F.array().cast("array<string>")))
    )


def readable_keys(
    tables: Mapping[str, DataFrame], rules: Thresholds = DEFAULTS
) -> tuple[DataFrame | None, dict[str, DataFrame], dict[str, str]]:
    """(dataset, columns, kind) of every table that can be read, those tables, and why the others cannot.

    All tables are read together. Only if that fails is each read on its own, so that a failing table fails alone. Without
    any readable table there are no keys.
    """
    if not tables:
        return None, {}, {}
    try:
        return _keys_of(tables, rules), dict(tables), {}
    except TABLE_ERRORS:
        parts, readable, failures = [], {}, {}
    for name in sorted(tables):
        try:
            parts.append(_keys_of({name: tables[name]}, rules))
        except TABLE_ERRORS as error:
            failures[name] = reason(error)
            continue
        readable[name] = tables[name]
    return (union_all(parts) if parts else None), readable, failures


def _keys_of(tables: Mapping[str, DataFrame], rules: Thresholds) -> DataFrame:
    stats = pinned(tables_stats(tables))
    parts = [
        table_keys(tables[name], rules, stats.where(F.col("dataset") == name).drop("dataset")).select(
            F.lit(name).alias("dataset"), "columns", "kind"
        )
        for name in sorted(tables)
    ]
    return pinned(union_all(parts))


def all_table_keys(tables: Mapping[str, DataFrame], rules: Thresholds = DEFAULTS) -> DataFrame:
    """(dataset, columns, kind) of every table; an error if one cannot be read."""
    keys, _, failures = readable_keys(tables, rules)
    if failures:
        raise ValueError(f"tables that cannot be read: {failures}")
    return keys


def analyze(
    tables: Mapping[str, DataFrame],
    failures: Mapping[str, str] | None = None,
    rules: Thresholds = DEFAULTS,
    name_map: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The whole relationship report, by section. Tables that fail while being read join the failures."""
    keys, tables, unreadable = readable_keys(tables, rules)
    failures = {**(failures or {}), **unreadable}
    if keys is None:
        raise LookupError(f"no table can be read: {failures}")
    single = keys.where("kind = 'single'").select("dataset", F.col("columns")[0].alias("column"))
    sizes = {name: df.count() for name, df in tables.items()}
    links = pinned(foreign_keys(tables, rules, name_map, single))
    counts = {"datasets": len(tables), "failed": len(failures)}
    failed = small_relation(keys.sparkSession, {"dataset": "string", "error": "string"}, sorted(failures.items()))
    return {
        "overview": dataset_overview(tables, keys, rules, sizes),
        "keys": keys,
        "matching_columns": matching_columns(tables, name_map, single),
        "relationships": links,
        "merge_guidance": merge_guidance(links),
        "standalone": standalone_tables(tables, links),
        "contributions": contributions(tables, sizes),
        "summary": relationship_summary(links).withColumns({k: F.lit(v) for k, v in counts.items()}),
        "failures": failed,
    }
