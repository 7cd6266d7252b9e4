"""All queries on the supplied tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, folder) under its name; ``sql`` gives the same rows."""

    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def load() -> None:
    """Imports the modules that register queries."""
    from quillframe.plans import attributed, carved, checked, emitted, grouped, joined, scalars, streamed, summed, validated  # noqa: F401
