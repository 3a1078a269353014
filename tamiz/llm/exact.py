"""Exact deduplication as a stateful stream.

Documents arrive in micro-batches. Keyed state on disk (RocksDB), kept for good, remembers for each
digest the smallest identifier seen, the locator of that document's content and how many there were.
A digest alone decides nothing: every hit is compared with the remembered document byte by byte, and
texts that only share a digest are told apart by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.common import only_in
from tamiz.session import materialise, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # an executor holds many small stores: neither logs nor write buffers set megabytes aside for each of them,
    # and stores of a query that has ended are closed soon
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """The state settings for a query that starts inside; the session's own come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    for k, v in STATE_SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def content_locator() -> Column:
    """Where a row's content lies: its file, and its row there."""
    return F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))


def stream_classes(stream: DataFrame, folder: str, digest=sha256) -> DataFrame:
    """Run a stream of (doc_id, text, locator) to the end of what there is, and return the state's view:
    (digest, keep_id, locator, seen), one row per digest.

    ``folder`` keeps checkpoint and class log; calling again with the same folder and more input goes on
    from the state. Each micro-batch overwrites its own part of the log, so one that is repeated
    after a failure changes nothing."""
    spark = stream.sparkSession
    classes = (
        stream.select("doc_id", "locator", digest(normalised(F.col("text"))).alias("digest"))
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("keep_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "locator")).alias("first"),
            F.count(F.lit(1)).alias("seen"),
        )
        .select("digest", "keep_id", F.col("first.locator").alias("locator"), "seen")
    )

    def log(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/classes/batch={number}")

    with state_on_disk(spark):
        writer = classes.writeStream.outputMode("update").foreachBatch(log).option("checkpointLocation", f"{folder}/checkpoint")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    logged = spark.read.parquet(f"{folder}/classes")
    last = F.max_by(F.struct("keep_id", "locator", "seen"), "batch")
    return logged.groupBy("digest").agg(last.alias("last")).select("digest", "last.*")


def deduplicate(spark: SparkSession, path: str, folder: str | None = None, bytes_a_batch: int = 4 << 30, digest=sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of the Parquet documents at ``path``.

    Texts are equal if they are identical once runs of white space are one space; NULL counts as empty.
    The smallest doc_id of a group stays; rows that repeat it are marked kept alike. A row without doc_id
    belongs to its group like any other, and is kept only if no row of the group has an id (keep_id is
    NULL then). Other columns are not read."""
    documents = spark.read.parquet(path)
    # as a pattern that matches itself only: a stream takes a single file by pattern, not by name
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(documents.schema).option("maxBytesPerTrigger", str(bytes_a_batch)).parquet(pattern)
    stream = stream.select("doc_id", "text", content_locator().alias("locator"))
    classes = stream_classes(stream, folder or scratch_path(spark, "exact"), digest)

    own = normalised(F.col("text"))
    contents = documents.select("doc_id", own.alias("text"), content_locator().alias("locator"))
    contents = contents.withColumn("digest", digest(F.col("text")))
    placed = contents.select("doc_id", "digest", sha256(F.col("text")).alias("text_sha256")).join(classes, "digest")
    # a hit is a document whose digest came more than once; it meets the one row the state points to
    repeated = classes.where(F.col("seen") > 1).select("digest", F.col("locator").alias("first_at"))
    hits = only_in(contents, repeated, "digest").join(repeated, "digest")
    first = hits.where(F.col("locator") == F.col("first_at")).select("digest", F.col("text").alias("first_text"))
    collided = materialise(hits.join(first, "digest").where(F.col("text") != F.col("first_text")).select("digest").distinct(), "collided")
    clean = placed.join(collided, "digest", "left_anti").select(
        "doc_id", "keep_id", F.col("seen").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    told_apart = only_in(contents, collided, "digest").join(collided, "digest", "left_semi")
    groups = told_apart.groupBy("digest", "text").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    apart = told_apart.join(groups, ["digest", "text"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha256(F.col("text")).alias("text_sha256")
    )
    return clean.unionByName(apart)
