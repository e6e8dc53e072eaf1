"""Queries of the library's operators over the test tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from . import drift, files, quality, records, shuffle

MODULES = [drift, files, quality, records, shuffle]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in getattr(module, "ORACLE_SQL", {}).items()}
