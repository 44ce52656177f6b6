"""The registered queries over the driver's tables and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "quote_grounding"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function as query ``name`` with its DuckDB twin ``sql``."""

    def register(function):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _ORACLES[name] = sql
        return function

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _ORACLES


def _load() -> None:
    from claimloom.plans import collection, evidence, models, releases, runs  # noqa: F401  they register their queries


_load()
