"""All registered queries and their SQL statements of the expected result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.plans import depth, live, quotes, runs, store
from feedloom.session import prepare

_MODULES = (quotes, depth, runs, live, store)


def _prepared(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return build(prepare(spark), sf)

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: _prepared(build)
        for module in _MODULES
        for name, (build, _) in module.QUERIES.items()
    }


def oracle_sql() -> dict[str, str]:
    return {
        name: sql.strip()
        for module in _MODULES
        for name, (_, sql) in module.QUERIES.items()
        if sql
    }
