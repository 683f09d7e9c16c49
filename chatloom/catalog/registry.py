"""Registered queries: a callable over the given tables and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``; ``tables`` reads one of the given tables by attribute."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


# Tables whose rows are texts or vectors: the work per row is heavy, so small files are spread over the cores.
HEAVY_ROWS = ("documents", "conversations", "pages", "embeddings")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(self.path(name))
        return spread(table) if name in HEAVY_ROWS else table
