"""Query registry: name -> Spark callable, SQL counterpart and survey rows covered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def add(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"duplicate query {fn.__name__}")
        QUERIES[fn.__name__] = Query(fn.__name__, tuple(covers.split()), fn, sql)
        return fn

    return add
