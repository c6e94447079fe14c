"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsloom.catalog import views
from newsloom.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The input tables of one folder and the views derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        return views.build(self, name, self.table)


def query(sql: str | None = None) -> Callable:
    """Register a function of :class:`Tables` under its own name."""

    def register(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return make(Tables(apply_settings(spark), folder))

        QUERIES[make.__name__] = run
        if sql is not None:
            ORACLES[make.__name__] = views.expand(sql)
        return make

    return register
