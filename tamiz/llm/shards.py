"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone: no ring, no table of shards. When one
more shard is appended, a key either stays or goes to the new shard, so only the fraction that the new
shard takes is moved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.llm.common import ship
from tamiz.session import materialise

#: Bytes of a document besides its text.
OVERHEAD = 8
FILE_BYTES = 256 << 20
#: Fixed values of jump consistent hashing: multiplier of the generator, and the bits of a draw.
MULTIPLIER = 2862933555777941757
DRAW_BITS = 31


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key among ``shards``.

    A key's generator draws how far it stays in a shard while shards are appended one by one: after shard
    ``b`` it next moves to shard ``floor((b + 1) / u)``, with ``u`` uniform. All keys that still move take
    their next step together, about ``log(shards)`` steps in all."""
    if shards < 1:
        raise ValueError("a table has at least one shard")
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        state[moving] = state[moving] * np.uint64(MULTIPLIER) + np.uint64(1)
        draw = (state[moving] >> np.uint64(64 - DRAW_BITS)).astype(np.float64) + 1
        # the quotient in doubles, as the published method has it
        after = ((shard[moving] + 1) * ((1 << DRAW_BITS) / draw)).astype(np.float64)
        goes = after < shards
        moving = moving[goes]
        shard[moving] = after[goes].astype(np.int64)
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a column of any type: its 64-bit hash, jumped in Arrow batches. Only the hash goes to Python.

    NULL is a key like any other and has one shard."""

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def with_slots(rows: DataFrame, shard: str = "shard", name: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap, in the order in which they are stored.

    The rows are written once with their place. A row's slot is its rank among the rows of its shard that the
    same task wrote, which a task's size bounds, and the number of such rows in the tasks before. So a shard
    or a key with any part of the rows never gathers in one task, and what is added up is one row for each
    shard and task."""
    placed = materialise(rows.withColumn("_at", F.monotonically_increasing_id()), "placed")
    task, inside = F.shiftright("_at", 33).alias("_task"), Window.partitionBy("_task", shard)
    counts = placed.groupBy(task, shard).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(shard).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = materialise(counts.select("_task", shard, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")), "slots")
    ranked = placed.select("*", task).withColumn("_rank", F.row_number().over(inside.orderBy("_at")))
    slot = (F.col("_before") + F.col("_rank") - 1).cast("long").alias(name)
    return ranked.join(before, ["_task", shard]).select(*rows.columns, slot)


def assign(docs: DataFrame, shards: int = 24, key: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text and eight more, ``grown_shard`` the shard after one more was
    appended: either ``shard`` or the new one. A NULL text is empty, with the checksum of no bytes. Rows that
    repeat a key, or have none (NULL), share its shard, each with a slot of its own, as the law asks.
    Texts of any length are measured in the JVM and never leave it. An empty table gives no rows. Columns beside
    the key and the text are left behind."""
    ship(docs.sparkSession)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    measured = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
    )
    return with_slots(measured).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def shard_sizes(assigned: DataFrame) -> DataFrame:
    """(shard, n_rows, n_bytes, n_moving): what each shard holds, and how much of it one more shard would take."""
    moving = F.count_if(F.col("grown_shard") != F.col("shard"))
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), moving.alias("n_moving"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, key: str = "doc_id", file_bytes: int = FILE_BYTES) -> None:
    """Store whole rows of ``docs`` under ``path``, one folder ``shard=N`` for each shard.

    Each shard's rows are dealt over as many tasks as its bytes need files, so that a shard with a third of all
    rows is written by many tasks. A column named ``shard`` is replaced."""
    ship(docs.sparkSession)
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long") + OVERHEAD
    placed = docs.withColumn("shard", shard_of(F.col(key), shards))
    needed = placed.groupBy("shard").agg(F.ceil(F.sum(size) / F.lit(file_bytes)).cast("int").alias("_files"))
    parts = {r["shard"]: max(1, r["_files"]) for r in needed.collect()}  # one number a shard
    if not parts:
        placed.write.mode("overwrite").partitionBy("shard").parquet(path)
        return
    files = F.element_at(F.create_map(*[F.lit(v) for pair in parts.items() for v in pair]), F.col("shard"))
    spread = F.pmod(F.xxhash64(F.lit(5), F.monotonically_increasing_id()), files)
    dealt = placed.withColumn("_file", spread).repartition(sum(parts.values()), "shard", "_file").drop("_file")
    dealt.write.mode("overwrite").partitionBy("shard").parquet(path)


def append_shard(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> DataFrame:
    """The rows that leave each of ``shards`` folders for a new one: (its columns, shard, grown_shard).

    ``docs`` is what :func:`write_shards` stored, with its column ``shard``. They are appended to ``path`` as the
    folder of the new shard; to delete them from where they were is left to the caller, who may still be reading."""
    ship(docs.sparkSession)
    moved = docs.withColumn("grown_shard", shard_of(F.col(key), shards + 1)).where(F.col("grown_shard") == shards)
    moved.drop("shard").withColumnRenamed("grown_shard", "shard").write.mode("append").partitionBy("shard").parquet(path)
    return moved
