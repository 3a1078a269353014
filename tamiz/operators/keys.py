"""Surrogate ids and the joins that resolve natural keys to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.session import materialise


def dense_ids(df: DataFrame, order: Sequence[str], name: str, first: int = 1) -> DataFrame:
    """Consecutive ids in the order of the given columns, without a single-task window.

    The rows are range-sorted and written once with their partition number and offset; an id
    is then the offset plus the rows of the partitions before, a list as long as there are
    partitions. NULLs come first.
    """
    ranged = df.orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.select(
        "_part",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    offset = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(before), "_part")
        .select((F.col("_before") + offset + first).alias(name), *df.columns)
    )


def extend_ids(known: DataFrame, found: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """``known`` (an id ``name`` for each key ``on``) and after it the keys of ``found`` it lacks, with ids past its
    highest, in the order of the key. Ids that were given stay for good, so whatever refers to them holds.

    Keys may be NULL. ``found`` is reduced to its keys before they are looked for; columns it does not have are NULL.
    ``known`` should be a stored table, since ids are read from it and its rows go on unchanged."""
    same = None
    for c in on:
        part = F.col(c).eqNullSafe(F.col(f"_known_{c}"))
        same = part if same is None else same & part
    held = known.select([F.col(c).alias(f"_known_{c}") for c in on])
    new = found.select(*on).distinct().join(held, same, "left_anti")
    highest = known.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    numbered = dense_ids(new, on, name, first=highest + 1)
    return known.unionByName(numbered, allowMissingColumns=True)


def resolve_key(
    fact: DataFrame, dim: DataFrame, on: dict[str, Column], id_column: str, how: str = "left"
) -> DataFrame:
    """Attach the id of a dimension row by a composite key whose parts may be NULL.

    ``on`` maps key columns of the dimension to expressions over the fact. NULL meets NULL.
    The dimension has one row per key; whether it is broadcast is left to its size.
    """
    keyed = dim.select(F.col(id_column), *[F.col(c).alias(f"_dim_{c}") for c in on])
    probe = fact.withColumns({f"_key_{c}": expression for c, expression in on.items()})
    condition = None
    for c in on:
        part = F.col(f"_key_{c}").eqNullSafe(F.col(f"_dim_{c}"))
        condition = part if condition is None else condition & part
    return probe.join(keyed, condition, how).select(id_column, *fact.columns)


def coarse_ids(dim: DataFrame, key: str, id_column: str) -> DataFrame:
    """The lowest id of each value of a coarser key (a province stands for its first canton)."""
    return dim.groupBy(key).agg(F.min(id_column).alias(id_column))
