"""Collects queries; the group modules fill it when they are imported."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from riskspark.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
GROUPS = (
    "sources", "cleaning", "joins", "aggregates", "windows", "functions", "evaluation", "audits", "learning", "plans", "streams",
)
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it gets a rows-only check."""
    def register(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(pin_utc(spark), sf_dir)

        _queries[name] = run
        if sql is not None:
            _oracles[name] = sql
        return fn

    return register


def _load() -> None:
    for group in GROUPS:
        import_module(f"riskspark.catalog.{group}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracles() -> dict[str, str]:
    _load()
    return dict(_oracles)
