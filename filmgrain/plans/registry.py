"""Registered queries: a Spark callable per operator, with the SQL that cross-checks it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filmgrain.plans.views import Catalogue, with_views

RUN: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

MODULES = (
    "sources", "rows", "joins", "aggregates", "functions", "documents", "integrity",
    "integration", "dependencies", "itemsets", "clusters", "named", "etl", "loading",
)


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None):
    """Register ``fn(catalogue)`` under ``name``; ``views`` adds SQL views for this query."""

    def register(fn: Callable[[Catalogue], DataFrame]):
        if name in RUN:
            raise ValueError(f"{name} registered twice")
        RUN[name] = lambda spark, folder: fn(Catalogue(spark, folder))
        if sql is not None:
            SQL[name] = with_views(sql, views)
        return fn

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"filmgrain.plans.inventory.{module}")
