"""The same results as plain DuckDB SQL over the supplied tables, written apart from the Spark code."""

from __future__ import annotations

MODULES = ("tables", "checks", "profiles", "defects", "repairs", "anomalies", "scores", "contracts")


def all_sql() -> dict[str, str]:
    import importlib

    found: dict[str, str] = {}
    for name in MODULES:
        found.update(importlib.import_module(f"oracle.{name}").ORACLE)
    return found
