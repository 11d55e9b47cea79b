"""All registered queries of the reference's operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldspark.session import ensure_importable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it is held against."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(ensure_importable(spark), sf_dir)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _load() -> None:
    from fieldspark.plans import queries, sources  # noqa: F401


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return QUERIES["akima_fill"](spark, sf_dir)
