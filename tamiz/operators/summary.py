"""Grouped totals, counts and shares."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.numbers import half_up, percent
from tamiz.functions.text import is_blank


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(name))


def top(df: DataFrame, by: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the highest ``by``, ties in the order of other columns."""
    return df.orderBy(F.col(by).desc_nulls_last(), *tie).limit(n)


def share_where(condition: Column, digits: int = 2) -> Column:
    """Percentage of the rows that meet a condition; 0 for no rows."""
    return percent(F.count_if(condition), F.count("*"), digits)


def share_within(df: DataFrame, group: Sequence[str], count: str, name: str, digits: int = 2) -> DataFrame:
    """Share in percent of each (already counted) row within its group."""
    whole = F.sum(count).over(Window.partitionBy(*group))
    return df.withColumn(name, half_up(F.col(count).cast("double") * 100 / whole, digits))


def repeated_keys(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once; a key with a NULL or blank part is no key."""
    blank = [is_blank(F.col(k).cast("string")) for k in keys]
    return df.where(~reduce(Column.__or__, blank)).groupBy(*keys).agg(F.count("*").alias(name)).where(F.col(name) > 1)


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, in one pass over the data."""
    counted = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    long = counted.unpivot(["_rows"], df.columns, "columna", "_filled")
    return long.select(
        "columna",
        (F.col("_rows") - F.col("_filled")).alias("nulos"),
        (F.col("_filled") == 0).alias("vacia"),
    )
