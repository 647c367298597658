"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function (spark, folder) -> DataFrame under ``name``."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, tuple(covers.split()), run, sql)
        return run

    return register
