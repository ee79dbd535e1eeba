"""Registry of named queries: a Spark plan builder and (optionally) its DuckDB oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    build: QueryFn
    oracle: str | None
    ids: tuple[str, ...]


_REGISTRY: dict[str, RegisteredQuery] = {}

_MODULES = (
    "ferrule.plans.dashboard_queries",
    "ferrule.plans.cleaning_queries",
    "ferrule.plans.load_queries",
    "ferrule.plans.refresh_queries",
    "ferrule.plans.ingest_queries",
    "ferrule.plans.sink_queries",
    "ferrule.plans.stream_queries",
    "ferrule.plans.table_queries",
    "ferrule.plans.feed_queries",
)


def register(name: str, oracle: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = RegisteredQuery(name, fn, oracle, ids)
        return fn
    return deco


def _load_all() -> None:
    for m in _MODULES:
        importlib.import_module(m)


def all_queries() -> dict[str, RegisteredQuery]:
    _load_all()
    return dict(_REGISTRY)
