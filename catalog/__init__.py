"""Queries over the sample tables, each with the SQL that gives the same rows.

Every query reads whole tables. ``QUERIES`` maps a name to a function of
(session, folder); ``ORACLES`` maps a name to SQL on the same tables, where SQL
can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, if given, its SQL."""
    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rnd(column: str | Column, digits: int = 6) -> Column:
    """Rounded value without a negative zero."""
    c = F.col(f"`{column}`") if isinstance(column, str) else column
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rounded(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    return df.select(*[rnd(c, columns[c]).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def load_all() -> None:
    from catalog import blends, clean, crosses, encoders, folds, groups, learners, profiles, stores, targets  # noqa: F401
