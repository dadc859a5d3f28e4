"""Queries by name, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import Views, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None, **views: str):
    """Register a function of :class:`Views`; ``sql`` may use the ``v_`` views and ``views``."""

    def register(build: Callable[[Views], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_views(sql, **views)
        return build

    return register
