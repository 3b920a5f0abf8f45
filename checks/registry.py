"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from checks.standins import Fx, oracle
from paygrain.functions.columns import money

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: Sequence[str] = ()):
    """Register ``f(fx)``; without ``sql`` the result is checked by tests only."""

    def register(f: Callable[[Fx], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: f(Fx(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(views, sql)
        return f

    return register


def dec(col: str, scale: int = 2) -> str:
    """SQL text: an average as a decimal that does not depend on the order of the sum."""
    return f"CAST(CAST({col} AS DECIMAL(24,6)) AS DECIMAL(18,{scale}))"


def rounded(df: DataFrame, **scales: int) -> DataFrame:
    """The Spark side of :func:`dec` for some columns."""
    new: dict[str, Column] = {c: money(df[c], 18, s) for c, s in scales.items()}
    return df.withColumns(new)
