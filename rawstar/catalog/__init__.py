"""Every operator as a named query over the given tables."""

from __future__ import annotations

import importlib

MODULES = ["expansion", "checking", "ingestion", "reshaping", "conversion", "faceting", "judging", "reviewing", "history", "comparing"]


def _registries():
    for name in MODULES:
        yield importlib.import_module(f"rawstar.catalog.{name}").reg


def all_queries() -> dict:
    return {k: fn for reg in _registries() for k, fn in reg.queries.items()}


def all_oracles() -> dict:
    return {k: sql for reg in _registries() for k, sql in reg.oracles.items()}
