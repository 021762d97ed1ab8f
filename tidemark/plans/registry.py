"""Collecting queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that computes the same rows where there is one."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Floating columns rounded, so both engines agree beyond the last bits."""
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, places).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def wide_ints(df: DataFrame) -> DataFrame:
    """Integers as bigint, the width the SQL side counts in."""
    kinds = dict(df.dtypes)
    return df.select(
        *[F.col(c).cast("bigint").alias(c) if kinds[c] in ("int", "smallint", "tinyint") else F.col(c) for c in df.columns]
    )


def tidy(df: DataFrame, places: int = 6) -> DataFrame:
    return wide_ints(rounded(df, places))
