"""Registry of named queries: key -> callable(spark, sf_dir) -> DataFrame.

Each query builds a lazy plan over the driver's tables; the matching DuckDB statement for
the correctness check lives in ``lakeshore.plans.oracle.ORACLE`` under the same key.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        return fn
    return deco


def load_all() -> dict[str, QueryFn]:
    # importing the modules registers their queries
    from lakeshore.plans import q_batches, q_clean, q_marts, q_quality, q_series  # noqa: F401
    return dict(QUERIES)
