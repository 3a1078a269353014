import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import simhash
from tamiz.llm.common import Forest, components


def linked(bits, distance):
    forest = Forest()
    for i, a in enumerate(bits):
        forest.root(a)
        for b in bits[:i]:
            if (a ^ b).bit_count() <= distance:
                forest.join(a, b)
    return forest


@pytest.mark.parametrize("distance", [2, 4, 5])
def test_links_against_all_pairs(spark, distance):
    rng = random.Random(distance)
    bits = {0, (1 << 64) - 1}
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 40])):
            x = centre
            for _ in range(rng.randrange(distance + 2)):
                x ^= 1 << rng.randrange(64)
            bits.add(x)
    bits = sorted(bits)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in bits]
    links = simhash.link_fingerprints(spark.createDataFrame(signed, "bits long"), distance).collect()
    want, got = linked(bits, distance), Forest()
    for a, b in links:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= distance
        got.join(a % (1 << 64), b % (1 << 64))
    assert [{x for x in bits if got.root(x) == got.root(y)} for y in bits] == [{x for x in bits if want.root(x) == want.root(y)} for y in bits]


def test_fingerprint_by_definition(spark):
    text = "One  two\tTHREE four\nfive one two three FOUR ééé"
    words = "one two three four five one two three four ééé".split()
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    hashes = [r[0] % (1 << 64) for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s")).collect()]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode(), 4) == want
    assert simhash.fingerprint(b" \n", 4) == 0
    assert simhash.fingerprint(b"a b", 4) == spark.range(1).select(F.xxhash64(F.lit("a b"))).first()[0] % (1 << 64)


def test_documents_against_all_pairs(documents):
    found = simhash.near_duplicates(documents).collect()
    rows = documents.collect()
    assert len(found) == len(rows)
    bits = [simhash.fingerprint((r["text"] or "").encode(), 4) for r in rows]
    forest, least = linked(sorted(set(bits)), 4), {}
    for r, b in zip(rows, bits):
        if r["doc_id"] is not None:
            least[forest.root(b)] = min(least.get(forest.root(b), r["doc_id"]), r["doc_id"])
    want = sorted((str(r["doc_id"]), b, least[forest.root(b)]) for r, b in zip(rows, bits))
    assert sorted((str(r["doc_id"]), r["bits"] % (1 << 64), r["component_id"]) for r in found) == want


def test_keep_one(documents, empty):
    kept = simhash.keep_one(documents)
    assert kept.columns == documents.columns
    rows = kept.collect()
    components_ = {r["component_id"] for r in simhash.near_duplicates(documents).collect()}
    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} <= components_
    with_id = [r for r in rows if r["doc_id"] is not None]
    assert len([r for r in with_id if r["text"] == with_id[0]["text"]]) == 1
    assert simhash.keep_one(empty).count() == 0


def test_components_of_long_chain(spark):
    rng = np.random.default_rng(0)
    order = rng.permutation(300).tolist()
    links = [(order[i], order[i + 1]) for i in range(299)] + [(1000, 1000), (1001, 1002), (1001, 1002), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(300)} | {1001: 1001, 1002: 1001}
