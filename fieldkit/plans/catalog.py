"""Registry of named queries: key -> (Spark callable, DuckDB oracle SQL).

Plan modules register their queries with :func:`register`; the driver entry
(``__spark_entry__.py``) reads :func:`queries` and :func:`oracle_sql`.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldkit.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: QueryFn
    sql: str | None
    ids: tuple[str, ...]


_REGISTRY: dict[str, Entry] = {}

PLAN_MODULES = ("census", "relational", "text", "scalars", "html", "mobility", "learn", "files")


def register(name: str, sql: str | None = None, views: tuple[str, ...] = (),
             ids: tuple[str, ...] = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB oracle (omitted for non-SQL operators), ``views``
    the fixture views it reads, ``ids`` the SURVEY inventory ids covered.
    """
    def deco(fn: QueryFn) -> QueryFn:
        old = _REGISTRY.get(name)
        if old is not None and old.fn.__qualname__ != fn.__qualname__:
            raise ValueError(f"duplicate query {name}")  # a module reload re-registers the same function
        _REGISTRY[name] = Entry(fn, with_views(sql, *views) if sql else None, tuple(ids))
        return fn
    return deco


def _load() -> dict[str, Entry]:
    for m in PLAN_MODULES:
        importlib.import_module(f"fieldkit.plans.{m}")
    return _REGISTRY


def queries() -> dict[str, QueryFn]:
    return {k: e.fn for k, e in _load().items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in _load().items() if e.sql}


def entries() -> dict[str, Entry]:
    return dict(_load())
