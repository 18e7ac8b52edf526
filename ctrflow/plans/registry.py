"""Named queries, each with its SQL twin where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; without ``sql`` only its rows can be checked."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            # the tables hold times without a zone, which SQL reads as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Round the named columns, as ``sql_round`` does."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def sql_round(expr: str, digits: int = 6) -> str:
    # adding 0.0 turns -0.0 into 0.0
    return f"round({expr}, {digits}) + 0.0"


def bigint(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]
