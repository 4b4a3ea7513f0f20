"""Pieces of checking SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from assayer.registry.inputs import check_sql


def with_input(name: str, body: str, alias: str = "t") -> str:
    return f"WITH {alias} AS {check_sql(name)} {body}"


def per_column(name: str, columns: Iterable[tuple[int, str]], row: Callable[[int, str], str]) -> str:
    """One SELECT per column of an input, stacked. ``row`` gives the select list after ordinal and column."""
    parts = [
        f"SELECT {i} AS ordinal, '{c}' AS \"column\", {row(i, c)} FROM t" for i, c in columns
    ]
    return with_input(name, " UNION ALL ".join(parts))


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"
