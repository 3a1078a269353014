"""Aggregates that are stored per load or period and put together when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.operators.audits import union_all

BUCKET, BITS = "cubeta", "mapa"


def distinct_state(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """For each ``by`` the set of whole numbers ``key``, as bitmaps: (``by``, cubeta, mapa).

    A bitmap holds the keys of one bucket of 32,768 and is 4 kB long, so keys should be dense, as surrogate ids are.
    Bits are set in every task before anything is shuffled; NULL is no key."""
    present = df.where(F.col(key).isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(BITS)
    return present.groupBy(*by, F.bitmap_bucket_number(key).alias(BUCKET)).agg(bits)


def merge_distinct(states: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """States put together: a key that several hold counts once. ``by`` may be a part of what they were kept by."""
    return union_all(states).groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def common_distinct(state: DataFrame, other: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each set in ``state``, which has one row for ``by`` and bucket, the keys that ``other`` (one set) holds too;
    where they share no bucket there is no row."""
    wanted = other.select(F.col(BUCKET).alias("_bucket"), F.col(BITS).alias("_bits"))
    pairs = state.join(wanted, F.col(BUCKET) == F.col("_bucket"))
    both = pairs.select(*by, BUCKET, F.explode(F.array(BITS, "_bits")).alias(BITS))
    return both.groupBy(*by, BUCKET).agg(F.bitmap_and_agg(BITS).alias(BITS))


def count_distinct(state: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact number of keys per ``by`` of a state with one row for ``by`` and bucket."""
    return state.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(name))


def coverage_state(df: DataFrame, source: str, period: str, checked: Sequence[str] = ()) -> DataFrame:
    """What :func:`coverage_of` needs of one load: rows, and rows with a NULL in a checked column, by period."""
    any_null = F.lit(False)
    for c in checked:
        any_null = any_null | F.col(c).isNull()
    return df.groupBy(F.lit(source).alias("fuente"), F.col(period).alias("periodo")).agg(
        F.count("*").alias("filas"), F.count_if(any_null).alias("filas_con_nulos")
    )


def coverage_of(states: Sequence[DataFrame]) -> DataFrame:
    """``operators.audits.coverage`` over all loads whose states are given; no row of the loads is read again."""
    periods = union_all(states).groupBy("fuente", "periodo").agg(F.sum("filas").alias("filas"), F.sum("filas_con_nulos").alias("filas_con_nulos"))
    return periods.groupBy("fuente").agg(
        F.min("periodo").alias("minimo"),
        F.max("periodo").alias("maximo"),
        F.count("periodo").alias("periodos"),
        F.sum("filas").alias("filas"),
        F.sum("filas_con_nulos").alias("filas_con_nulos"),
    )


def sum_state(df: DataFrame, by: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Sums per ``by`` that add up over loads; exact ones (``functions.numbers.exact_sum``) whatever the order."""
    return df.groupBy(*by).agg(*[c.alias(name) for name, c in sums.items()])


def merge_sums(state: DataFrame, by: Sequence[str], names: Sequence[str]) -> DataFrame:
    return state.groupBy(*by).agg(*[F.sum(name).alias(name) for name in names])
