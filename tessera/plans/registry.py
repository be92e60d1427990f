"""Where the query modules register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Tables with long texts, and their keys: worth spreading when a file has too few splits.
WIDE = {"documents": "doc_id", "pages": "page_id"}


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(table, WIDE[name]) if name in WIDE else table


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and, where SQL can say the same, its SQL."""
    def add(fn):
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
