"""Registration of queries by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.standins import Standins

Query = Callable[[Standins], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a function under its own name."""
    if build.__name__ in QUERIES:
        raise ValueError(f"query {build.__name__} is registered twice")
    QUERIES[build.__name__] = build
    return build


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Standins(spark, sf_dir))

    return {name: bind(build) for name, build in QUERIES.items()}
