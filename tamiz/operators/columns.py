"""Shaping of schemas: renaming, flattening, resolving, conforming."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.numbers import whole_or_null
from tamiz.functions.text import snake_name


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def rename_by_position(df: DataFrame, names: dict[int, str]) -> DataFrame:
    """Keep the columns at the given positions under new names."""
    columns = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return columns.select([F.col(f"_{i}").alias(name) for i, name in names.items()])


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def lower_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterable[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten(df: DataFrame, column: str, last_segment: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One column per leaf of a struct column, and the columns to ``keep`` as they are.

    Names join the path with ``_``, or are its last part only; they are in snake case. Of
    columns that end up with the same name the first is kept, blank names are dropped.
    """
    chosen: dict[str, Column] = {}
    for path in _leaves(df.schema[column].dataType):
        name = snake_name(path[-1] if last_segment else "_".join(path))
        if name and name not in chosen:
            source = ".".join(f"`{part}`" for part in (column, *path))
            chosen[name] = F.col(source).alias(name)
    return df.select(*[c for name, c in chosen.items() if name not in keep], *keep)


def resolve(columns: Sequence[str], has: Sequence[str], lacks: Sequence[str] = (), any_of: bool = False) -> str:
    """First column whose name holds all (or any) of some fragments and none of others."""
    test = any if any_of else all
    for name in columns:
        if test(part in name for part in has) and not any(part in name for part in lacks):
            return name
    raise LookupError(f"no column with {' or '.join(has) if any_of else ' and '.join(has)} in {list(columns)}")


def _in_type(df: DataFrame, field: T.StructField) -> Column:
    """A column in the type of ``field``; text such as ``12.0`` is a whole number too."""
    c = F.col(field.name)
    if isinstance(field.dataType, T.IntegralType) and isinstance(df.schema[field.name].dataType, T.StringType):
        return F.coalesce(c.try_cast(field.dataType), whole_or_null(c).try_cast(field.dataType))
    return c.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types; missing ones become NULL, others are dropped."""
    return df.select(
        [
            (_in_type(df, f) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def conform_losses(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many values :func:`conform` cannot express in the target type."""
    shared = [f for f in schema.fields if f.name in df.columns]
    lost = df.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & _in_type(df, f).isNull()).alias(f.name)
            for f in shared
        ]
    )
    return lost.unpivot([], [f.name for f in shared], "columna", "valores_perdidos")


def conform_lost(df: DataFrame, schema: T.StructType) -> Column:
    """An aggregate over ``df``: values of all columns that :func:`conform` cannot express. Columns that come in
    their target type lose nothing and are not looked at."""
    changed = [f for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    lost = [F.when(F.col(f.name).isNotNull() & _in_type(df, f).isNull(), 1).otherwise(0) for f in changed]
    return F.sum(sum(lost, F.lit(0)))


def keep_wanted(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select([c for c in wanted if c in df.columns])


def missing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]
