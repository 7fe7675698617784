"""The list of queries, and the pieces their definitions share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL of the same result."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(name: str, digits: int = 2) -> Column:
    """Sums of floating numbers depend on the order of the rows; checks compare them rounded."""
    return F.round(F.col(name), digits).alias(name)


def island_sql(x: str) -> str:
    """The island code of an expression, in SQL."""
    digits = f"regexp_replace(cast({x} as varchar), '[^0-9]', '', 'g')"
    return f"lpad(substr({digits}, 1, 2), 2, '0')"


def island_key_sql(x: str) -> str:
    return f"cast(cast({island_sql(x)} as int) as varchar)"
