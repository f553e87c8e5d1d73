"""All queries of the engine's own operators, with their DuckDB equivalents.

A module of ``sparkloom`` registers a query with :func:`query`; its key is the
operator's id and a short name.
"""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "c06_combined_coverage"


class Tables:
    """The tables of a folder as DataFrames, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """Tasks for what grows out of few bytes, which Spark would give to fewer of them by the size of its input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` is what DuckDB runs for the same rows."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load() -> None:
    """Import every module that registers queries."""
    import sparkloom

    for package in ("operators", "functions", "sources", "plans", "streaming"):
        for found in pkgutil.iter_modules([f"{sparkloom.__path__[0]}/{package}"]):
            importlib.import_module(f"sparkloom.{package}.{found.name}")
