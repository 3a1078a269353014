"""SimHash near-duplicates by deletion variants.

A 64-bit fingerprint is cut into three segments. Two fingerprints that differ in at most four bits
differ in at most one bit of some segment, so each segment is indexed once per position with that bit
taken out: equal variants are candidates, and the bits of the whole fingerprints decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, Forest, components, map_batches, runs, utf8_bytes, whole_runs, whole_texts
from tamiz.session import materialise

SEED = 42
VOTES_AT_ONCE = 1 << 16
#: Runs up to this length are compared by shifting the whole column against itself.
SHORT_RUN = 24


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width): so many that one of them differs by at most one bit."""
    count = distance // 2 + 1
    edges = [round(i * 64 / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def fingerprint(text: bytes, words_a_shingle: int) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(words_a_shingle, len(words))
    starts = np.r_[0, ends[:-1] + 1][: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), VOTES_AT_ONCE):
        part = hashes[at : at + VOTES_AT_ONCE]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_a_shingle: int = 4) -> DataFrame:
    """(doc_id, bits): one row per row of ``docs``; a text without words has bits 0. Map only."""

    def read(batches: Batches) -> Batches:
        for batch in batches:
            bits = np.array([fingerprint(t, words_a_shingle) for t in utf8_bytes(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "bits"])

    return map_batches(whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id")), read, "doc_id long, bits long")


def _variants(bits, distance: int):
    """Keys of all variants: the position taken out, above that segment without it."""
    keys = []
    for first, width in segments(distance):
        part = F.shiftrightunsigned(bits, first).bitwiseAND(F.lit((1 << width) - 1))
        keys += [part.bitwiseAND(F.lit(~(1 << i))).bitwiseOR(F.lit((first + i) << 32)) for i in range(width)]
    return F.array(*keys)


def _links(distance: int):
    """Links within runs of equal keys, each pair of fingerprints under one key only."""
    cuts = segments(distance)
    masks = np.array([((1 << w) - 1) << f for f, w in cuts], dtype=np.uint64)
    segment_of = np.concatenate([np.full(w, i) for i, (_, w) in enumerate(cuts)])
    first_of = np.array([f for f, _ in cuts], dtype=np.int64)

    def own(key: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether fingerprints that differ by ``x`` link, and this key is where the pair is counted: in the
        first segment that differs by at most a bit, at that bit, or at its first position if none does."""
        position = key >> 32
        segment = segment_of[position]
        good = np.bitwise_count(x) <= distance
        for s in range(len(cuts) - 1):
            good &= (segment <= s) | (np.bitwise_count(x & masks[s]) > 1)
        mine = x & masks[segment]
        bit = np.uint64(1) << position.astype(np.uint64)
        return good & ((mine == bit) | ((mine == 0) & (position == first_of[segment])))

    def long_run(key: int, bits: np.ndarray):
        """A spanning forest of the run's links: each fingerprint looks once at those not reached yet."""
        rest = np.sort(bits)
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                here = queue.pop()
                reached = np.bitwise_count(rest ^ here) <= distance
                for there in rest[reached].tolist():
                    yield int(here), there
                queue.extend(rest[reached])
                rest = rest[~reached]

    def find(batches: Batches) -> Batches:
        for table in whole_runs(batches):
            key = table.column(0).to_numpy()
            bits = table.column(1).to_numpy().view(np.uint64)
            starts, lengths = runs(key)
            a, b = [], []
            for start, length in zip(starts[lengths > SHORT_RUN].tolist(), lengths[lengths > SHORT_RUN].tolist()):
                for x, y in long_run(int(key[start]), bits[start : start + length]):
                    a.append(np.uint64(x))
                    b.append(np.uint64(y))
            firsts, seconds = [np.array(a, np.uint64)], [np.array(b, np.uint64)]
            keep = np.repeat((lengths > 1) & (lengths <= SHORT_RUN), lengths)
            key, bits = key[keep], bits[keep]
            for shift in range(1, SHORT_RUN):
                if len(key) <= shift:
                    break
                same = np.flatnonzero(key[shift:] == key[:-shift])
                if not len(same):
                    break
                x = bits[same] ^ bits[same + shift]
                good = same[own(key[same], x)]
                firsts.append(bits[good])
                seconds.append(bits[good + shift])
            a, b = np.concatenate(firsts), np.concatenate(seconds)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return find


def link_fingerprints(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """(a, b) between distinct fingerprints (column ``bits``) at most ``distance`` bits apart.

    Within a long run of one variant only a spanning forest is kept: what is linked stays linked
    through it, while the rows stay in proportion to the run."""
    spark = distinct.sparkSession
    keyed = distinct.select(F.explode(_variants(F.col("bits"), distance)).alias("key"), "bits")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(keyed.repartition(parts, "key").sortWithinPartitions("key"), _links(distance), "a long, b long")


def near_duplicates(docs: DataFrame, words_a_shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, bits, component_id) for each row of ``docs``.

    Copies have one fingerprint and are linked as one node, however many there are; ``component_id`` is
    the smallest doc_id reachable. NULL texts count as empty and link with each other. A row without
    doc_id takes part but never names a component (NULL if no row of its component has an id)."""
    rows = materialise(fingerprints(docs, words_a_shingle), "fingerprints")
    classes = materialise(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    links = link_fingerprints(classes.select("bits"), distance)
    reached = components(links).withColumnsRenamed({"node": "bits"})
    placed = classes.join(reached, "bits", "left").withColumn("component", F.coalesce("component", "bits"))
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("bits", "component_id")
    return rows.join(named, "bits")


def keep_one(docs: DataFrame, words_a_shingle: int = 4, distance: int = 4) -> DataFrame:
    """The document of the smallest doc_id of each component, columns unchanged; a row repeated as a whole
    stays once. Rows without doc_id all stay."""
    found = near_duplicates(docs, words_a_shingle, distance)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    chosen = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return chosen.unionByName(docs.where(F.col("doc_id").isNull()))
