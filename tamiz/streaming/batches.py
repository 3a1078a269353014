"""Loading in bounded batches with a fixed schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tamiz.session import scratch_path
from tamiz.sources.tables import remove, swap_table


def load_in_batches(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    files_per_batch: int = 1000,
    checkpoint: str | None = None,
) -> None:
    """Append the files below ``source`` to ``target``, a bounded number at a time.

    ``shape`` is a stateless transformation. With a lasting ``checkpoint`` a second run loads
    only files that arrived since, and a run cut short goes on where it stopped. Without one
    the load starts afresh and takes the place of ``target`` once it is complete, so that running
    it again gives the same table.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    into = target if checkpoint else f"{target.rstrip('/')}.new"
    if not checkpoint:
        remove(spark, into)
    query = (
        shape(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start(into)
    )
    query.awaitTermination()
    if not checkpoint:
        remove(spark, f"{into}/_spark_metadata")  # it names the files where they were written
        swap_table(spark, into, target)
