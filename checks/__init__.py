"""Every operator as a query on the given tables, with the SQL it must agree with."""

from __future__ import annotations

from importlib import import_module

MODULES = ("q_values", "q_series", "q_runs", "q_files", "q_plans")


def load() -> tuple[dict, dict]:
    """All queries and all oracles by name."""
    from checks.registry import ORACLES, QUERIES

    for module in MODULES:
        import_module(f"checks.{module}")
    return QUERIES, ORACLES
