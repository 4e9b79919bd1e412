"""Registered queries and the SQL each of them is checked against."""

from __future__ import annotations

from importlib import import_module

MODULES = ["texts", "moments", "fields", "rows", "joined", "counts", "people", "groups", "web", "files"]


def load() -> tuple[dict, dict]:
    """All registered queries and their check SQL."""
    for name in MODULES:
        import_module(f"marquee.catalog.{name}")
    from marquee.catalog.registry import QUERIES, SQL

    return dict(QUERIES), dict(SQL)
