"""Queries over the standard tables, each beside the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, tuple[Callable[["Tables"], DataFrame], str | None]] = {}


class Tables:
    """The parquet tables of one folder: ``t.orders``, ``t.lineitem`` and so on."""

    def __init__(self, spark: SparkSession, path: str):
        # Wall-clock times in the tables are UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.path = path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with its SQL, if there is one."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn

    return add
