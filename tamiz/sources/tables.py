"""Parquet tables: replace, append, guarded and in-place refresh."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIODS_AT_ONCE = 1000


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; with its schema given, no file is opened to find it."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a table partition side by side, so that a task does not write a small file for
    each of them. The rebalance splits a partition that is too large for one task."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def files_of(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and a function from text to its paths."""
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), to_path


def remove(spark: SparkSession, path: str) -> None:
    files, to_path = files_of(spark, path)
    files.delete(to_path(path), True)


def swap_table(spark: SparkSession, staged: str, path: str) -> None:
    """Put a complete table in place of another. Until the new one has the name, the old one is whole
    beside it under ``path.old``, which a later replacement puts back or removes."""
    files, to_path = files_of(spark, path)
    target, old = to_path(path), to_path(f"{path}.old")
    if files.exists(target):
        files.delete(old, True)
        files.rename(target, old)
    files.mkdirs(target.getParent())
    if not files.rename(to_path(staged), target):
        raise OSError(f"{staged} could not be moved to {path}")
    files.delete(old, True)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` in place of whatever is at ``path``, which ``df`` may read from.

    The rows are complete beside the table before it is touched, so a job that is lost leaves the
    old table as it was."""
    _replace(df, path, partition_by)


def _replace(df: DataFrame, path: str, partition_by: Sequence[str], unless_empty: bool = False) -> bool:
    spark, path = df.sparkSession, path.rstrip("/")
    staged = f"{path}.new"
    laid_out(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
    if unless_empty and spark.read.schema(df.schema).parquet(staged).isEmpty():
        remove(spark, staged)
        return False
    swap_table(spark, staged, path)
    return True


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    laid_out(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_unless_empty(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Replace the table only if there are rows to load; tells whether it did. The plan runs once: what was
    written beside the table is looked at before it takes the name."""
    return _replace(df, path, partition_by, unless_empty=True)


def write_csv(df: DataFrame, path: str, sep: str = ";") -> None:
    """CSV files with a header. Cells keep their spaces; a quote in a quoted cell is doubled."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "quote": '"', "escape": '"'}
    df.write.mode("overwrite").options(header=True, sep=sep, encoding="UTF-8", **kept).csv(path)


def archive_and_rebuild(
    spark: SparkSession, path: str, archive: str, build: Callable[[DataFrame], DataFrame]
) -> None:
    """Keep the flat table as the staged copy, then build the final table from that copy."""
    replace_table(read_table(spark, path), archive)
    replace_table(build(read_table(spark, archive)), path)


def refresh_in_place(
    spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()
) -> None:
    """Replace a table by a function of itself.

    One write: the result is complete beside the table before that is touched.
    """
    replace_table(change(read_table(spark, path)), path, partition_by)


def update_matched(
    target: DataFrame, source: DataFrame, key: str, values: Sequence[str], flag: str | None = None
) -> DataFrame:
    """``target`` with ``values`` taken from ``source`` where the key matches, NULLs included.

    A source that repeats a key ends the job: it would multiply rows of the target. ``flag`` names an
    optional column telling matched rows.
    """
    grouped = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*values)).alias("_new"))
    single = F.assert_true(F.col("_n") == 1, F.lit(f"the source of an update repeats a value of {key}")).isNull()
    new = grouped.select(key, single.alias("_hit"), *[F.col(f"_new.{v}").alias(f"_new_{v}") for v in values])
    joined = target.join(new, key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    columns = [
        F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in target.columns
    ]
    return joined.select(*columns, *([hit.alias(flag)] if flag else []))


def rows_of_new_periods(new: DataFrame, existing: DataFrame, period: str) -> DataFrame:
    """Rows of ``new`` whose period ``existing`` does not hold yet.

    Only the period column of ``existing`` is read. Up to :data:`PERIODS_AT_ONCE` periods are asked for by
    value, so that of a table partitioned by period only their partitions are opened. NULL is a period too.
    """
    asked = [r[0] for r in new.select(period).distinct().limit(PERIODS_AT_ONCE + 1).collect()]
    if len(asked) <= PERIODS_AT_ONCE:
        values = [v for v in asked if v is not None]
        existing = existing.where(F.col(period).isin(values) | F.col(period).isNull())
    present = existing.select(F.col(period).alias("_present")).distinct()
    return new.join(present, F.col(period).eqNullSafe(F.col("_present")), "left_anti").select(new.columns)


def append_new_periods(new: DataFrame, path: str, period: str) -> None:
    """Append the periods the table lacks; running it again adds nothing."""
    existing = read_table(new.sparkSession, path, new.schema)
    append_table(rows_of_new_periods(new, existing, period), path, [period])
