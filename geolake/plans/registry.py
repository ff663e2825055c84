"""Queries by name, each with its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


# Means of decimals often end in an exact half of the last digit kept, which two engines may
# round either way. Adding this first, on both sides, moves such values off the border.
NUDGE = 1.2345e-7


def rounded(df: DataFrame, digits: int = 6, nudge: float = 0.0) -> DataFrame:
    """Every double column rounded, so that two engines agree on the last bits."""
    return df.select(*(
        F.round(F.col(f"`{name}`") + nudge if nudge else F.col(f"`{name}`"), digits).alias(name)
        if kind == "double" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ))
