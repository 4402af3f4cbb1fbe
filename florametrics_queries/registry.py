"""Registry of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from florametrics.session import bounded_shuffles, prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent check on the same tables."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(bounded_shuffles(prepare(spark)), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def digest_sql(seed: int, *values: str) -> str:
    """The library's portable digest of values that are not missing, in SQL."""
    text = " || ".join(f"'|=' || CAST({v} AS VARCHAR)" for v in values)
    return f"CAST('0x' || substr(md5('{seed}' || {text}), 1, 13) AS BIGINT)"


def unit_sql(seed: int, *values: str) -> str:
    return f"(({digest_sql(seed, *values)} + 0.5::DOUBLE) / 4503599627370496::DOUBLE)"
