"""The registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its DuckDB oracle where SQL can express it."""

    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if oracle is not None:
            _ORACLES[name] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _ORACLES
