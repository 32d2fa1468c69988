"""Registration of queries together with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from listing_lake.catalog.views import VIEWS, Views, with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, views: Sequence[str] = (), name: str | None = None):
    """Register a function of :class:`Views` under its own name.

    ``sql`` is the same result in plain SQL over the tables and the adapter ``views``.
    """
    unknown = set(views) - VIEWS.keys()
    if unknown:
        raise ValueError(f"unknown views {sorted(unknown)}")

    def register(build: Callable[[Views], DataFrame]):
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Views(spark, folder))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_clause(views, sql)
        return build

    return register
