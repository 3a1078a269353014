"""Row filters and one-row-per-key reductions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.text import blank_to_null, missing_to_null


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def contains_ci(c: Column, text: str) -> Column:
    """``LIKE '%text%'`` that ignores case."""
    escaped = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return c.ilike(f"%{escaped}%")


def clear_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Texts that stand for a missing value become NULL in the listed columns."""
    return df.withColumns({c: missing_to_null(F.col(c)) for c in columns})


def clear_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c)) for c in columns})


def blank_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values :func:`clear_blank` clears per column."""
    counted = df.agg(
        *[F.count_if(F.col(c).isNotNull() & blank_to_null(F.col(c)).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot([], list(columns), "columna", "filas_limpiadas")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first whole row of each key in the given order.

    The filter on the row number is applied within each task before the shuffle too (Spark's
    window group limit), so a key that holds a large share of the rows moves one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def value_of_last(value: str, order: Column) -> Column:
    return F.max_by(value, order)


def value_of_first(value: str, order: Column) -> Column:
    return F.min_by(value, order)


def latest_period(df: DataFrame, period: str) -> DataFrame:
    """Rows of the highest period: an uncorrelated scalar subquery on that one column."""
    newest = df.agg(F.max(period)).scalar()
    return df.where(F.col(period) == newest)
