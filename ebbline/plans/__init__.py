"""The registered queries of the engine, by family, with their SQL."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("ingest", "marts", "network", "timelines", "care", "billing", "nested")


def queries() -> dict:
    return {k: v for f in FAMILIES for k, v in import_module(f"{__name__}.{f}").QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for f in FAMILIES for k, v in import_module(f"{__name__}.{f}").SQL.items()}
