"""Registration of bound queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordflow.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("extract", "expressions", "quality", "search", "files", "runs", "structuring")


class Inputs:
    """The driver's tables of one folder, as attributes; other access by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, name, self.folder)


def bind(name: str, sql: str | None = None):
    """Register ``fn(inputs)`` under ``name``."""
    def register(fn: Callable[[Inputs], DataFrame]):
        _QUERIES[name] = lambda spark, folder: fn(Inputs(spark, folder))
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"recordflow.bindings.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
