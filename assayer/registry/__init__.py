"""Registered queries: a callable per operator and the SQL that checks it."""

from __future__ import annotations

from assayer.registry.catalog import Query, all_queries

__all__ = ["Query", "all_queries"]
