"""Collects every registered query."""

from __future__ import annotations

from importlib import import_module

from tablewright.plans.registry import QUERIES, Query

MODULES = ("cleaning", "shaping", "splitting", "scoring", "ranking", "registering", "watching", "learning", "storing")


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"tablewright.plans.{module}")
    return QUERIES
