"""Star tables: dimensions enriched first, then a fact joined with them, and values with a fallback."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.config import LIMITS, Limits
from assayer.functions.columns import nan_to_null, ref
from assayer.plans.master import JoinSpec, build_master
from assayer.session import pinned


@dataclass(frozen=True)
class StarTable:
    """One table of a star: what it starts from and what joins it. Later tables can join earlier ones by name."""

    name: str
    base: str
    steps: list[JoinSpec]


def star_tables(
    tables: Mapping[str, DataFrame],
    stars: list[StarTable],
    failures: Mapping[str, str] | None = None,
    limits: Limits = LIMITS,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(tables, diagnostics) by name, in order. A table that later ones join is stored once."""
    known, built, reports = dict(tables), {}, {}
    for i, star in enumerate(stars):
        table, reports[star.name] = build_master(known, star.base, star.steps, failures, limits)
        later = {step.table for other in stars[i + 1 :] for step in other.steps} | {s.base for s in stars[i + 1 :]}
        built[star.name] = known[star.name] = pinned(table) if star.name in later else table
    return built, reports


def with_fallback(df: DataFrame, name: str, choices: list[list[str]]) -> DataFrame:
    """Adds ``name`` and ``name_from``: the first choice that has a value, and which one it was.

    A choice is a list of columns, of which the mean counts if none is missing.
    """
    df = nan_to_null(df)
    parts = []
    for columns in choices:
        total = sum((ref(c).cast("double") for c in columns[1:]), ref(columns[0]).cast("double"))
        parts.append((total / F.lit(float(len(columns))), " and ".join(columns)))
    used = F.coalesce(*[F.when(value.isNotNull(), label) for value, label in parts])
    return df.withColumns({name: F.coalesce(*[value for value, _ in parts]), f"{name}_from": used})
