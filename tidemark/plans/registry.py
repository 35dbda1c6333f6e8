"""Registry of the queries, each with the SQL that must give the same table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def r(column: str | Column, places: int = 6) -> Column:
    """Rounded for comparison; adding zero turns a negative zero into zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), places) + F.lit(0.0)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Every DOUBLE column rounded."""
    return df.withColumns({n: r(n, places) for n, t in df.dtypes if t == "double"})


def sr(expression: str, name: str, places: int = 6) -> str:
    """The SQL form of ``r``."""
    x = f"round(CAST({expression} AS DOUBLE), {places})"
    return f"CASE WHEN {x} = 0 THEN CAST(0 AS DOUBLE) ELSE {x} END AS {name}"
