"""The list of runnable queries, each with the SQL that another engine can check it by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from millrace.functions import round_half_up
from millrace.session import load, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Tables of one test-data folder as attributes: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register a function from Tables to DataFrame, with its check SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(prepare(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def r(col: Column, digits: int) -> Column:
    """Rounding of doubles that the check SQL repeats with ``r_sql``."""
    return round_half_up(col, digits)


def r_sql(expr: str, digits: int) -> str:
    return f"floor(({expr}) * 1e{digits} + 0.5) / 1e{digits}"
