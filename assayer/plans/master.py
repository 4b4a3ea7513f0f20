"""Master tables: a fact enriched step by step, and a cleaned text table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.config import LIMITS, Limits
from assayer.functions.relations import small_relation
from assayer.operators.clean import clean_text_counts, clean_text_rows
from assayer.operators.frequency import logical_size, union_all
from assayer.operators.joins import join_diagnostics, left_join, skipped_step
from assayer.session import pinned


@dataclass(frozen=True)
class JoinSpec:
    """One enrichment step. ``reduce`` brings a many-to-one side to one row per key."""

    table: str
    key: str
    suffix: str = "_right"
    name: str | None = None
    reduce: Callable[[DataFrame], DataFrame] | None = None
    null_safe: bool = False

    @property
    def title(self) -> str:
        return self.name or f"+ {self.table}"


def build_master(
    tables: Mapping[str, DataFrame],
    fact: str,
    steps: list[JoinSpec],
    failures: Mapping[str, str] | None = None,
    limits: Limits = LIMITS,
) -> tuple[DataFrame, DataFrame]:
    """The enriched fact and one diagnostics row per step.

    A missing table skips its step and says why; without the fact there is
    nothing to build.
    """
    if fact not in tables:
        raise LookupError(f"no fact table {fact!r}: {(failures or {}).get(fact, 'not loaded')}")
    master = tables[fact]
    # A table with the same keys as the master: the fact itself until a step adds rows. Diagnostics and hot keys are taken
    # from it, so that no step runs the joins before it again.
    keys = master
    report = []
    for number, step in enumerate(steps, 1):
        if step.table not in tables:
            reason = (failures or {}).get(step.table, "not loaded")
            row = pinned(skipped_step(keys, step.key, step.title, reason))
        else:
            # a reduced table is measured, described and joined: it is computed once
            right = tables[step.table] if step.reduce is None else pinned(step.reduce(tables[step.table]))
            for side, df in ((fact, master), (step.table, right)):
                if step.key.lower() not in (c.lower() for c in df.columns):
                    raise ValueError(f"step {number} ({step.title}): {side} has no column {step.key!r}")
            if step.key not in keys.columns:  # a key that an earlier step brought
                master = keys = pinned(master)
            row = pinned(join_diagnostics(_counted(keys, master), right, step.key, step.suffix, step.title, step.null_safe))
            master = left_join(master, right, step.key, step.suffix, step.null_safe, limits, keys)
            if row.first()["row_count_changed"]:
                master = keys = pinned(master)
        report.append(row.select(F.lit(number).alias("step"), "*"))
    if not report:
        return master, small_relation(master.sparkSession, {"step": "int", "step_name": "string"}, [])
    return master, union_all(report)


def _counted(keys: DataFrame, master: DataFrame) -> DataFrame:
    """The rows of ``keys`` under all column names of the master, so that collisions of names are seen."""
    missing = [c for c in master.columns if c not in keys.columns]
    return keys.withColumns({c: F.lit(None) for c in missing}) if missing else keys


def build_text_master(df: DataFrame, text_column: str) -> tuple[DataFrame, DataFrame]:
    """The cleaned text table and what was removed from it."""
    return clean_text_rows(df, text_column), clean_text_counts(df, text_column)


def table_report(name: str, df: DataFrame, ignored: list[str] | None = None) -> DataFrame:
    """(dataset, rows, columns, bytes, schema, ignored) of a finished table."""
    schema = [f"{f.name}: {f.dataType.simpleString()}" for f in df.schema.fields]
    return logical_size(df).select(
        F.lit(name).alias("dataset"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        "bytes",
        F.array(*[F.lit(s) for s in schema]).cast("array<string>").alias("schema"),
        F.array(*[F.lit(n) for n in ignored or []]).cast("array<string>").alias("ignored"),
    )
