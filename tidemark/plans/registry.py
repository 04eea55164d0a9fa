"""The checked queries: a Spark callable each and, where SQL can say it, the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL when there is one."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return query

    return register
