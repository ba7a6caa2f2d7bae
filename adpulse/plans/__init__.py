"""Registered queries over the test tables, and the SQL that checks them."""

from __future__ import annotations

from . import oracles as _oracles, queries, window_oracles, window_queries


def registry() -> dict[str, queries.Query]:
    """All queries by name."""
    return queries.registry() | window_queries.registry()


def oracles() -> dict[str, str]:
    """SQL per registered query."""
    return _oracles.oracles() | window_oracles.oracles()


__all__ = ["oracles", "registry"]
