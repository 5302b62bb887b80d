"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.fixtures import duckdb, fixture

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of fixtures by name, and the SQL for DuckDB that gives the same rows."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: fixture(spark, sf_dir, name))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def oracles() -> dict[str, str]:
    return {n: duckdb(s) for n, s in SQL.items()}


def rounded(c: str, digits: int) -> Column:
    """A column of doubles rounded as the SQL's round does it: the scaled double's half goes away from zero. Spark's own
    rounds the shortest decimal instead, which is another number where the scaled double is just below a half."""
    scale = 10.0**digits
    x = F.abs(F.col(c)) * scale
    return F.signum(c) * (F.floor(x) + F.when(x - F.floor(x) >= 0.5, 1.0).otherwise(0.0)) / scale
