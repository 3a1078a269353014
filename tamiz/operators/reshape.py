"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.numbers import number_or_null


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str, value: str) -> DataFrame:
    """One row per value column, as numbers; cells that hold no number are left out."""
    numeric = df.select(*ids, *[number_or_null(F.col(v)).alias(v) for v in values])
    return numeric.unpivot(list(ids), list(values), variable, value).dropna(subset=[value])


def to_wide(
    df: DataFrame,
    keys: Sequence[str],
    variable: str,
    value: str,
    names: dict[str, str],
    order: Column,
) -> DataFrame:
    """One column per listed value of ``variable``: the first non-NULL value in ``order``, the least of equals.

    Rows with a NULL key are left out. Columns of values that never occur are NULL. One
    aggregation with partial combine; no rows are gathered per group.
    """
    filled = df.dropna(subset=list(keys)).where(F.col(value).isNotNull())
    columns = [
        F.min(F.when(F.col(variable) == level, F.struct(order.alias("o"), F.col(value).alias("v")))).getField("v").alias(name)
        for level, name in names.items()
    ]
    return filled.groupBy(*keys).agg(*columns)
