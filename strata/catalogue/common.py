"""Shared pieces of the query catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


class Catalogue:
    """Queries by name, with SQL twins."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None):
        def register(fn: Query) -> Query:
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, label)


def day(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def moment(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
