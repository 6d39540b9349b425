"""All queries of the engine and their SQL, gathered from the operator modules."""

from __future__ import annotations

import importlib

MODULES: list[str] = ["record_queries", "evaluation_queries", "ingest_queries", "run_queries", "open_queries"]


def _gather(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(importlib.import_module(f"gleanery.plans.{name}"), attribute)
    return out


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict:
    return _gather("ORACLE")
