"""Named queries on the test tables and, where SQL can say the same, their checks."""

from __future__ import annotations

from importlib import import_module

MODULES = ("parsing", "cleaning", "aggregates", "text_mining", "models", "storage", "streams", "invariants")


def queries() -> dict:
    found: dict = {}
    for name in MODULES:
        found.update(import_module(f"loglake.registry.{name}").QUERIES)
    return found


def oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found.update(import_module(f"loglake.registry.{name}").ORACLES)
    return found
