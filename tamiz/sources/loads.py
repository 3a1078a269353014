"""Figures of a load, taken by the job that writes it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "tabla string, medida string, valor bigint"


class Figures:
    """Counts that pass by while tables are written, so that no table is read again for them.

    A count is an accumulator of the running job: of a task that runs twice it may count rows twice. What a load
    decides never depends on it."""

    def __init__(self) -> None:
        self._observed: list[tuple[str, Observation]] = []
        self._known: list[tuple[str, str, int]] = []

    def take(self, df: DataFrame, table: str, **figures: Column) -> DataFrame:
        """``df``, whose rows are counted when it is written."""
        observation = Observation(f"{table}-{uuid.uuid4().hex}")
        self._observed.append((table, observation))
        return df.observe(observation, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in figures.items()])

    def add(self, table: str, figure: str, value: int) -> None:
        """A figure that is known anyway."""
        self._known.append((table, figure, value))

    def report(self, spark: SparkSession) -> DataFrame:
        """(tabla, medida, valor). To be asked for when all observed frames have been written."""
        observed = [(table, name, value) for table, o in self._observed for name, value in o.get.items()]
        return spark.createDataFrame(sorted([*observed, *self._known]), REPORT)


class Loaded(dict):
    """Stored tables by name, with the figures of the load that wrote them."""

    def __init__(self, tables: dict[str, DataFrame], report: DataFrame):
        super().__init__(tables)
        self.report = report


def take(figures: Figures | None, df: DataFrame, table: str, **counted: Column) -> DataFrame:
    return df if figures is None else figures.take(df, table, **counted)


def all_rows() -> Column:
    return F.count(F.lit(1))

