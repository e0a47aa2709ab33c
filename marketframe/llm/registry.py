"""Queries on the text tables: one per operator and the whole pipeline, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = run
        if sql:
            _SQL[name] = sql
        return run

    return register


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    from . import queries  # noqa: F401

    return _QUERIES | {"pipeline": corpus_pipeline.run}


def llm_sql() -> dict[str, str]:
    import corpus_pipeline

    from . import queries  # noqa: F401

    return _SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
