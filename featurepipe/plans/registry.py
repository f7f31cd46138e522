"""Where queries register themselves, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featurepipe.sources.readers import read_parquet

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, table folder) under its own name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet", spread=spread)


def rounded(expression: str) -> str:
    """SQL for a value rounded like ``round6``: half away from zero, and no negative zero."""
    return f"CASE WHEN round({expression}, 6) = 0 THEN 0.0 ELSE round({expression}, 6) END"
