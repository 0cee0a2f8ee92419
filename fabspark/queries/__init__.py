"""Registered queries and the SQL each is checked against."""

from importlib import import_module

MODULES = ["rows", "gold_tables", "charts", "statistics", "io"]


def load() -> None:
    """Import every module that registers queries."""
    for m in MODULES:
        import_module(f"fabspark.queries.{m}")
