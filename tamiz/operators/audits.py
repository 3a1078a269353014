"""Data-quality reports, each a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.charset import looks_damaged, redecode
from tamiz.functions.numbers import percent
from tamiz.functions.text import is_ascii, is_blank
from tamiz.operators.summary import repeated_keys


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Non-blank values of a reference that the parent lacks, with their row counts.

    Rows are counted per value before the join, so that a frequent value is one row of it.
    """
    used = child.select(F.col(column).alias("clave")).where(F.col("clave").isNotNull())
    if isinstance(child.schema[column].dataType, type(parent.schema[key].dataType)) and dict(child.dtypes)[column] == "string":
        used = used.where(~is_blank(F.col("clave")))
    counted = used.groupBy("clave").agg(F.count("*").alias("filas"))
    return counted.join(parent.select(F.col(key).alias("clave")), "clave", "left_anti")


def reference_check(
    child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_name: str, key: str
) -> DataFrame:
    """One report row: values set, rows whose reference has no parent, share in percent.

    The child is grouped once: found and missing keys come from one left join.
    """
    counted = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("clave")).agg(F.count("*").alias("filas"))
    known = parent.select(F.col(key).alias("clave"), F.lit(1).alias("_known")).distinct()
    joined = counted.join(known, "clave", "left")
    missing = F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("filas"))), F.lit(0))
    total = F.coalesce(F.sum("filas"), F.lit(0))
    return joined.agg(
        F.lit(child_name).alias("tabla"),
        F.lit(column).alias("columna"),
        F.lit(parent_name).alias("tabla_referida"),
        total.alias("con_valor"),
        missing.alias("sin_referencia"),
        percent(missing, total, 3).alias("pct_sin_referencia"),
    )


def child_references(child: DataFrame, child_name: str, references: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """:func:`reference_check` for several references ``(column, referred table, its rows, key)`` of one table.

    The table is read once: its reference columns are put one below the other, as text, and counted
    per value before the one join with all referred keys.
    """
    numbered = list(enumerate(references))
    cells = F.array(*[F.struct(F.lit(i).alias("n"), F.col(column).cast("string").alias("clave")) for i, (column, *_) in numbered])
    used = child.select(F.inline(cells).alias("n", "clave")).where(F.col("clave").isNotNull())
    counted = used.groupBy("n", "clave").agg(F.count("*").alias("filas"))
    known = union_all(
        [rows.select(F.lit(i).alias("n"), F.col(key).cast("string").alias("clave")) for i, (_, _, rows, key) in numbered]
    )
    joined = counted.join(known.distinct().withColumn("_known", F.lit(1)), ["n", "clave"], "left")
    total = lambda i, *also: F.coalesce(F.sum(F.when(reduce(Column.__and__, also, F.col("n") == i), F.col("filas"))), F.lit(0))
    sums = joined.agg(*[total(i).alias(f"t{i}") for i, _ in numbered], *[total(i, F.col("_known").isNull()).alias(f"m{i}") for i, _ in numbered])
    report = [
        F.struct(
            F.lit(child_name).alias("tabla"), F.lit(column).alias("columna"), F.lit(parent).alias("tabla_referida"),
            F.col(f"t{i}").alias("con_valor"), F.col(f"m{i}").alias("sin_referencia"),
            percent(F.col(f"m{i}"), F.col(f"t{i}"), 3).alias("pct_sin_referencia"),
        )
        for i, (column, parent, _, _) in numbered
    ]
    return sums.select(F.inline(F.array(*report)))


def check_references(tables: dict[str, DataFrame], references: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Report over declared references ``(table, column, referred table, referred key)``."""
    by_child: dict[str, list[tuple[str, str, DataFrame, str]]] = {}
    for child, column, parent, key in references:
        by_child.setdefault(child, []).append((column, parent, tables[parent], key))
    return union_all([child_references(tables[child], child, own) for child, own in by_child.items()])


def code_share(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows with a code, those whose code the parent lacks, and their share; blank codes are none."""
    coded = child.select(F.col(column)).where(~is_blank(F.col(column).cast("string")))
    report = reference_check(coded, "", column, parent, "", key)
    return report.select("columna", F.col("con_valor").alias("con_codigo"), F.col("sin_referencia").alias("sin_catalogo"), F.col("pct_sin_referencia").alias("pct_sin_catalogo"))


def check_required(tables: dict[str, DataFrame], schemas: dict[str, T.StructType]) -> DataFrame:
    """Rows with a NULL in a column declared as required, per table and column."""
    reports = []
    for name, df in tables.items():
        required = [f.name for f in schemas[name].fields if not f.nullable]
        if required:
            counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
            long = counted.unpivot([], required, "columna", "nulos")
            reports.append(long.select(F.lit(name).alias("tabla"), "columna", "nulos"))
    return union_all(reports)


def check_unique(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    """Keys declared unique that occur more than once, and the surplus rows, per table."""
    return union_all(
        [
            duplicate_summary(tables[name], columns).select(
                F.lit(name).alias("tabla"), F.lit(", ".join(columns)).alias("clave"), "claves_repetidas", "filas_sobrantes"
            )
            for name, columns in keys.items()
        ]
    )


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur more than once and how many surplus rows that makes."""
    return repeated_keys(df, keys).agg(
        F.count("*").alias("claves_repetidas"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("filas_sobrantes"),
    )


def blank_share(df: DataFrame, column: str) -> DataFrame:
    blank = F.count_if(is_blank(F.col(column).cast("string")))
    return df.agg(
        F.lit(column).alias("columna"),
        F.count("*").alias("filas"),
        blank.alias("vacias"),
        percent(blank, F.count("*")).alias("pct_vacias"),
    )


def unmatched_share(df: DataFrame, id_column: str) -> DataFrame:
    """Rows whose lookup found nothing, after a left join."""
    lost = F.count_if(F.col(id_column).isNull())
    return df.agg(
        F.count("*").alias("filas"),
        lost.alias("sin_coincidencia"),
        percent(lost, F.count("*")).alias("pct_sin_coincidencia"),
    )


def damaged_text(df: DataFrame, column: str) -> DataFrame:
    """Count of texts with marks of a wrong charset, and of texts with other letters than ASCII."""
    c = F.col(column)
    return df.agg(
        F.lit(column).alias("columna"),
        F.count("*").alias("filas"),
        F.count_if(looks_damaged(c)).alias("con_marcas"),
        F.count_if(~is_ascii(c)).alias("no_ascii"),
    )


def accented_sample(df: DataFrame, column: str, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows whose text has other letters than ASCII, to look at."""
    return df.where(~is_ascii(F.col(column))).orderBy(*order).limit(n)


def charset_scores(df: DataFrame, column: str, charsets: Sequence[str]) -> DataFrame:
    """Per candidate charset, the share of texts that its reversal decodes. One pass."""
    decodable = df.agg(
        F.count(column).alias("_filas"),
        *[F.count(redecode(F.col(column), charset)).alias(charset) for charset in charsets],
    )
    return decodable.unpivot(["_filas"], list(charsets), "charset", "decodificadas").select(
        "charset",
        F.col("_filas").alias("filas"),
        "decodificadas",
        percent(F.col("decodificadas"), F.col("_filas"), 2).alias("pct"),
    )


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns, types and row count of every table."""
    frames = []
    for name, df in tables.items():
        columns = F.array(*[F.struct(F.lit(c).alias("columna"), F.lit(t).alias("tipo")) for c, t in df.dtypes])
        frames.append(
            df.agg(F.count("*").alias("filas")).select(
                F.lit(name).alias("tabla"), "filas", F.inline(columns).alias("columna", "tipo")
            )
        )
    return union_all(frames)


def coverage(df: DataFrame, source: str, period: str, checked: Sequence[str] = ()) -> DataFrame:
    """First, last and number of periods, rows, and rows with a NULL in any checked column."""
    any_null = reduce(Column.__or__, [F.col(c).isNull() for c in checked], F.lit(False))
    return df.agg(
        F.lit(source).alias("fuente"),
        F.min(period).alias("minimo"),
        F.max(period).alias("maximo"),
        F.countDistinct(period).alias("periodos"),
        F.count("*").alias("filas"),
        F.count_if(any_null).alias("filas_con_nulos"),
    )


def unbalanced(df: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """Rows whose total is not the sum of its parts."""
    return df.where(F.col(total) != reduce(Column.__add__, [F.col(p) for p in parts]))


def load_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a load, and the net of new rows, in one report row."""
    counted = union_all(
        [df.agg(F.lit(side).alias("lado"), F.count("*").alias("n")) for side, df in (("antes", before), ("despues", after))]
    )
    sides = [F.sum(F.when(F.col("lado") == side, F.col("n"))).alias(side) for side in ("antes", "despues")]
    return counted.agg(*sides).withColumn("nuevas", F.col("despues") - F.col("antes"))


def view_rows(views: dict[str, DataFrame]) -> DataFrame:
    """Row count of every view; an empty or broken view shows up here."""
    return union_all([df.agg(F.lit(name).alias("vista"), F.count("*").alias("filas")) for name, df in views.items()])
