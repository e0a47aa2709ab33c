"""Registry of queries: a Spark plan over the given tables, and the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .oracle_shapes import with_shapes
from .shapes import Shapes

_PLANS: dict[str, Callable[[Shapes], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a plan under its function name together with its comparison SQL."""

    def register(plan: Callable[[Shapes], DataFrame]):
        key = name or plan.__name__
        if key in _PLANS:
            raise ValueError(f"query registered twice: {key}")
        _PLANS[key] = plan
        if sql is not None:
            _SQL[key] = with_shapes(sql)
        return plan

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import audit_queries, clean_queries, daily_queries, merge_queries, source_queries  # noqa: F401

    return {name: (lambda spark, folder, plan=plan: plan(Shapes(spark, folder))) for name, plan in _PLANS.items()}


def all_sql() -> dict[str, str]:
    all_queries()
    return dict(_SQL)
