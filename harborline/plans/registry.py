"""Registry of named queries and the SQL each is compared with."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

MODULES = (
    "source_queries",
    "column_queries",
    "cleaning_queries",
    "join_queries",
    "aggregate_queries",
    "window_queries",
    "scalar_queries",
    "panel_queries",
    "learning_queries",
    "retrieval_queries",
    "cash_queries",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__ = name
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"harborline.plans.{module}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
