import zlib

import numpy as np
from pyspark.sql import functions as F

from tamiz.llm import shards


def plain_jump(key, n):
    """One key at a time, with Python's unbounded integers."""
    b, j, key = -1, 0, key % 2**64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_against_one_key_at_a_time():
    rng = np.random.default_rng(3)
    keys = np.r_[rng.integers(-(2**63), 2**63 - 1, 2000), 0, 1, -1, 2**63 - 1, -(2**63)]
    for n in (1, 2, 3, 24, 25, 1000, 1 << 20):
        assert shards.jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    assert shards.jump(np.zeros(0, np.int64), 24).tolist() == []


def test_one_more_shard_takes_its_part_only():
    keys = np.random.default_rng(4).integers(-(2**63), 2**63 - 1, 200_000)
    for n in (1, 7, 24):
        old, new = shards.jump(keys, n), shards.jump(keys, n + 1)
        moved = old != new
        assert set(new[moved].tolist()) == {n}
        assert abs(moved.mean() - 1 / (n + 1)) < 0.005
        assert np.bincount(new, minlength=n + 1).std() < 0.05 * len(keys) / (n + 1)


def test_assign(documents):
    rows = shards.assign(documents).collect()
    texts = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in documents.collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == texts
    slots, of = {}, {}
    for r in rows:
        assert r["law"] == "key" and 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
        of.setdefault(r["doc_id"], set()).add((r["shard"], r["grown_shard"]))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())


def test_shard_follows_key_alone(spark, documents):
    """Whatever the order, the neighbours or the number of partitions."""
    again = documents.orderBy(F.desc("text")).coalesce(1).where("doc_id % 2 = 0").withColumn("shard", F.lit(99)).withColumn("_at", F.lit(1))
    first = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in shards.assign(documents).collect()}
    rows = shards.assign(again).collect()
    assert rows and all(first[r["doc_id"]] == (r["shard"], r["grown_shard"]) for r in rows)
    hashes = spark.range(500).select("id", F.xxhash64("id").alias("h"), shards.shard_of(F.col("id"), 24).alias("s")).collect()
    assert all(r["s"] == plain_jump(r["h"], 24) for r in hashes)


def test_hot_key_is_numbered_by_many_tasks(spark):
    rows = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    found = shards.assign(rows)
    got = found.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.min("slot").alias("l"), F.countDistinct("slot").alias("d")).collect()
    assert sum(r["n"] for r in got) == 30_000 and max(r["n"] for r in got) > 10_000
    assert all(r["l"] == 0 and r["m"] == r["n"] - 1 and r["d"] == r["n"] for r in got)


def test_empty_table(empty):
    assert shards.assign(empty).count() == 0


def test_written_shards_hold_whole_rows_and_grow(spark, documents, empty, tmp_path):
    path = f"file://{tmp_path}/shards"
    shards.write_shards(documents, path, 6, file_bytes=2000)
    stored = spark.read.parquet(path)
    assert stored.drop("shard").exceptAll(documents).count() == 0 and documents.exceptAll(stored.drop("shard").select(documents.columns)).count() == 0
    files = stored.select("shard", F.input_file_name().alias("f")).distinct().groupBy("shard").count().collect()
    assert max(r["count"] for r in files) > 1
    moved = shards.append_shard(stored, f"file://{tmp_path}/more", 6)
    grown = spark.read.parquet(f"file://{tmp_path}/more")
    assert grown.select("shard").distinct().collect()[0][0] == 6 and grown.count() == moved.count() > 0
    sizes = shards.shard_sizes(shards.assign(documents, 6))
    assert sizes.agg(F.sum("n_moving")).first()[0] == moved.count() and sizes.agg(F.sum("n_rows")).first()[0] == documents.count()
    shards.write_shards(empty, f"file://{tmp_path}/none", 6)
