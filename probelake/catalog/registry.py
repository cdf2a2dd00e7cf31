"""Collects queries and their SQL counterparts by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, case_sensitive: bool = False) -> Callable[[Query], Query]:
    """Registers a query. Without ``sql`` it is checked in the tests only.

    The SQL side knows no time zones, so the session is put on UTC. With ``case_sensitive`` the result has columns whose
    names differ in case alone, which Spark writes and reads back only in a session that tells them apart.
    """

    def register(fn: Query) -> Query:
        @wraps(fn)
        def on_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.caseSensitive", str(case_sensitive).lower())
            return fn(spark, sf_dir)

        QUERIES[name] = on_utc
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


from . import feed_rows, kpis, landing, parsing, tables_and_ledgers  # noqa: E402, F401
