"""Every operator run over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilwork.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a function (spark, table folder) -> DataFrame under a name."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        return run

    return register


def all_queries() -> dict[str, Query]:
    from veilwork.queries import cleaning, governance, learning, loading, profiling, warehouse  # noqa: F401

    return dict(QUERIES)
