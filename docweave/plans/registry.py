"""Registry of named queries: Spark callable + optional DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .oracle_views import with_views


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register ``fn(spark, data_dir)``; ``sql`` gets the view CTEs it needs."""

    def deco(fn):
        full = with_views(sql, ctes) if sql is not None else None
        REGISTRY[name] = Query(name, fn, full, (fn.__doc__ or "").strip())
        return fn

    return deco


# --- output helpers shared by the queries --------------------------------

def joined(c, sep: str = "|") -> Column:
    """Array -> string (the order the array has)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c, sep)


def sorted_joined(c, sep: str = "|") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.array_sort(c), sep)
