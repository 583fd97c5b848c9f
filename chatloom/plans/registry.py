"""Registered queries: name -> (Spark job over the given tables, equivalent DuckDB SQL or None).

The SQL side is the correctness oracle. Queries without SQL are checked by row count and by the
unit tests' brute-force fixtures.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    # importing the modules fills the registry
    from chatloom.plans import (q_curate, q_dataset, q_extract, q_generate, q_links, q_select,  # noqa: F401
                                q_store, q_text)
