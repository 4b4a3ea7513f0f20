"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    check: str | None


_REGISTERED: dict[str, Query] = {}


def query(name: str, check: str | None = None):
    """Register a function (spark, folder) -> DataFrame under a name."""

    def register(run):
        if name in _REGISTERED:
            raise ValueError(f"{name} registered twice")
        _REGISTERED[name] = Query(name, run, check)
        return run

    return register


def all_queries() -> dict[str, Query]:
    from assayer.registry import cleaning, faults, integration, matching, profiling, quality, relations, sources, stars  # noqa: F401

    return dict(_REGISTERED)
