"""Registry of the queries and of the SQL text their results are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with SQL that gives the same rows where SQL can express it."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rnd(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Round every double column, so that the order of summation cannot show."""

    def fix(name: str) -> Column:
        return F.round(F.col(f"`{name}`"), other.get(name, digits)) + F.lit(0.0)

    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({n: fix(n) for n in doubles})


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    """SQL twin of :func:`rnd` for one output column."""
    return f"round({expr}, {digits}) + 0 AS {name or expr}"


def rs(*names: str, digits: int = 6) -> str:
    return ", ".join(r(n, n, digits) for n in names)
