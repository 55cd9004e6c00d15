"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Run], Run]:
    """Register a function, under its own name unless another is given."""

    def register(run: Run) -> Run:
        QUERIES[name or run.__name__] = Query(run, sql)
        return run

    return register
