"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from tapelake.plans.market_sql import with_views
from tapelake.sources.views import Market

Builder = Callable[[Market], DataFrame]

_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a query on the market views, and the SQL that must return the same rows."""

    def register(builder: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = builder
        if sql is not None:
            _SQL[name] = with_views(sql)
        return builder

    return register


_MARKETS: WeakKeyDictionary[SparkSession, dict[str, Market]] = WeakKeyDictionary()


def market(spark: SparkSession, path: str) -> Market:
    """The views over a folder, analyzed once per session; they are plans, so nothing is kept but their definitions."""
    known = _MARKETS.setdefault(spark, {})
    if path not in known:
        known[path] = Market(spark, path)
    return known[path]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(builder: Builder) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, path: builder(market(spark, path))

    return {name: bind(builder) for name, builder in _QUERIES.items()}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
