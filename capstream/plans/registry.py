"""The query registry: ``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle_sql or None)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    if name in QUERIES:
        raise ValueError(f"query {name!r} registered twice")

    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = (fn, sql)
        return fn
    return deco


def sql_round(c: Column | str, digits: int) -> Column:
    """Round like the oracle's ``round_text``: to ``digits + 3`` places, then ``digits``.

    Each step scales, rounds half away from zero and unscales, as SQL engines
    do (Spark's ``round`` works from the double's shortest decimal text, which
    differs on halves such as 43.472812499999996). The first step removes the
    last-bit noise of order-dependent float sums, so an exact tie (an average
    of 2-decimal values over 32 rows ends in ...5 at the 7th place) rounds the
    same way on both engines.
    """
    c = F.col(c) if isinstance(c, str) else c
    for d in (digits + 3, digits):
        scale = float(10 ** d)
        c = F.round(c * F.lit(scale)) / F.lit(scale)
    return c


def round_text(expr: str, digits: int) -> str:
    """The SQL side of ``sql_round``."""
    return f"round(round({expr}, {digits + 3}), {digits})"


def spark_round_text(expr: str, digits: int) -> str:
    """``sql_round`` written as Spark SQL text."""
    for d in (digits + 3, digits):
        expr = f"round(({expr}) * 1e{d}) / 1e{d}"
    return expr
