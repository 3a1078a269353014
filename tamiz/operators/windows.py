"""Moving averages over a frame of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.numbers import EXACT, half_up
from tamiz.operators.keys import dense_ids


def _frame_mean(value: str, frame, digits: int) -> Column:
    exact = F.col(value).cast(EXACT)
    return half_up(F.sum(exact).over(frame).cast("double") / F.nullif(F.count(exact).over(frame), F.lit(0)), digits)


def trailing_mean(
    df: DataFrame, order: Sequence[str], value: str, name: str, rows: int = 30, digits: int = 2, series: Sequence[str] = ()
) -> DataFrame:
    """Mean of the current row and those before it, ``rows`` in all (fewer at the start).

    For one row per day and series: the longest series is as long as its calendar.
    :func:`trailing_mean_of_rows` does the same for a series of any length.
    """
    frame = Window.partitionBy(*series).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return df.withColumn(name, _frame_mean(value, frame, digits))


def trailing_mean_of_rows(
    df: DataFrame, order: Sequence[str], value: str, name: str, rows: int = 30, digits: int = 2, chunk: int = 1_000_000,
    series: Sequence[str] = (),
) -> DataFrame:
    """:func:`trailing_mean` over series of any length, and any number of them.

    Rows are numbered by series and order and cut into chunks, whatever series they belong to; each chunk also
    gets the last rows of the one before, which fill the frames of its first rows where the series goes on, and are
    dropped afterwards. A series with a third of all rows is as many chunks as it takes, short ones share a chunk.
    """
    if chunk < rows:
        raise ValueError("a chunk must hold at least one frame")
    numbered = dense_ids(df, [*series, *order], "_pos", first=0).withColumn("_own", F.floor(F.col("_pos") / chunk))
    tail = F.col("_pos") % chunk >= chunk - (rows - 1)
    homes = F.when(tail, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
    spread = numbered.withColumn("_chunk", F.explode(homes))
    frame = Window.partitionBy("_chunk", *series).orderBy("_pos").rowsBetween(-(rows - 1), 0)
    return (
        spread.withColumn(name, _frame_mean(value, frame, digits))
        .where(F.col("_chunk") == F.col("_own"))
        .select(*df.columns, name)
    )
