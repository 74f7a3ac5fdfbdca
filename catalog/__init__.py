"""Query catalogue: every operator run on the given tables, with its reference SQL."""

from __future__ import annotations

from importlib import import_module

SECTIONS = ["quality", "reports", "cleaning", "model", "loading", "kpis", "primitives"]


def all_queries():
    """All registered queries by name."""
    for section in SECTIONS:
        import_module(f"catalog.{section}")
    return import_module("catalog.registry").QUERIES
