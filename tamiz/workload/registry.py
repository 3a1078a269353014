"""Registry of queries over the driver tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables of one scale factor, looked up on first access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(self.path(name))
        setattr(self, name, table)
        return table


def query(sql: str | None = None, name: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables under the given name or its own."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


def sql_sum(x: str, digits: int = 2) -> str:
    return f"CAST(round(sum(CAST({x} AS DECIMAL(24,6))), {digits}) AS DOUBLE)"


def sql_round(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def sql_avg(x: str, digits: int = 2) -> str:
    return sql_round(f"CAST(sum(CAST({x} AS DECIMAL(24,6))) AS DOUBLE) / nullif(count({x}), 0)", digits)
