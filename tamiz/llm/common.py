"""What several corpus operators share: reading columns, Arrow batches, runs of equal keys, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tamiz
from tamiz.session import materialise

Batches = Iterator[pa.RecordBatch]


#: Rows of whole texts in one Arrow batch, unless the session says otherwise.
BATCH_ROWS = 2000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Python workers are kept for later tasks; what a task has freed goes back to the system.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20)}


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver found it, and bound their memory.

    On a cluster the package reaches executors the usual way (``--py-files`` or an image)."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.abspath(tamiz.__file__)))
    environment = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def whole_texts(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``text`` with NULL as empty; whatever else the table has is left behind."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def map_batches(df: DataFrame, function: Callable[[Batches], Batches], schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def held_out(doc_id, parts: int, part: int):
    """Whether crc32 of the id, written as text, leaves ``part``. A row without an id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


#: A filter of keys has this many places for each key, and at most 2 ** MOST_PLACES in all: 16 MB, whatever the input.
PLACES_PER_KEY, LEAST_PLACES, MOST_PLACES = 16, 15, 27
CHUNK = 15  # bits of a place within one bitmap of Spark's, which holds 32,768


def key_filter(keys: DataFrame, hashed: Column) -> tuple[DataFrame, int]:
    """(chunk, bits) and the number of bits of a place: bitmaps that mark every key, ``hashed`` to 64 bits, by the top bits of
    its hash. Its size follows the number of keys up to a bound, beyond which more keys that are not there pass."""
    bits = int(np.ceil(np.log2(PLACES_PER_KEY * max(1, keys.count()))))
    bits = min(MOST_PLACES, max(LEAST_PLACES, bits))
    place = F.shiftrightunsigned(hashed, 64 - bits)
    chunk, within = F.shiftright(place, CHUNK).alias("chunk"), place.bitwiseAND((1 << CHUNK) - 1)
    return keys.select(chunk, within.alias("within")).groupBy("chunk").agg(F.bitmap_construct_agg("within").alias("bits")), bits


def only_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be in ``wanted``: all that are, and some whose hash falls in the same place.

    What is broadcast is bounded, however long ``wanted`` is (see :func:`key_filter`), so wide rows that are
    not wanted can be left out before an exact join without being shuffled."""
    marks, bits = key_filter(wanted, F.xxhash64(key))
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    within = place.bitwiseAND((1 << CHUNK) - 1)
    byte = F.conv(F.hex(F.substr("bits", (F.shiftright(within, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = marks.select(F.col("chunk").alias("_chunk"), "bits")
    met = rows.withColumn("_within", within).join(F.broadcast(held), F.shiftright(place, CHUNK) == F.col("_chunk"))
    return met.where(F.getbit(byte, F.col("_within").bitwiseAND(7).cast("int")) == 1).select(rows.columns)


def utf8_bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal neighbours."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return starts, np.diff(np.r_[starts, len(keys)])


def whole_runs(batches: Batches, key: int = 0) -> Iterator[pa.Table]:
    """Regroup batches sorted by column ``key`` so that no run of equal keys is cut.

    Only the last run of a batch waits for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if waiting and (last or waiting[0].column(key)[0].as_py() != keys[0]):
            yield pa.Table.from_batches([*waiting, batch.slice(0, last)])
            waiting = []
        elif last:
            yield pa.Table.from_batches([batch.slice(0, last)])
        waiting.append(batch.slice(last))
    if waiting:
        yield pa.Table.from_batches(waiting)


class Forest:
    """Union-find over whatever hashes; ``join`` says whether two trees became one."""

    def __init__(self):
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): each node that has a link, and the smallest node it can reach.

    Alternating stars: first every larger neighbour of a node is hung on the smallest of its
    neighbourhood, then every smaller one; rounds grow with the logarithm of the longest chain.
    Each round is aggregations and joins of links by node, written to the shared folder, so lineage
    stays short and a lost executor costs one round at most. A node with a third of all links is
    reduced by partial minima, and AQE splits its side of the joins."""
    u, v = F.col("u"), F.col("v")
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(u.isNotNull() & v.isNotNull() & (u != v))
        .distinct()
    )
    edges = materialise(edges, "links")
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("m").alias("v")).where(u != v).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.groupBy("u").agg(F.min("v").alias("v")).select(u.alias("node"), v.alias("component")).unionByName(
        edges.select(v.alias("node"), v.alias("component")).distinct()
    )
