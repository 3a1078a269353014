import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tamiz.llm import packing


def test_ids_are_the_tokenizers(corpus):
    slow = Tokenizer.from_file(packing.default_vocabulary())
    ids_of = packing.TokenIds(packing.default_vocabulary())
    texts = [t or "" for _, t, *_ in corpus] + ["a  b \n\n c\t", "it's we'll 12 ½ ²³ naïve—x", "<|endoftext|> x", " x \u0085y", "Ⅷ ǅ ʰ"]
    for text in texts:
        assert ids_of(text).tolist() == slow.encode(text, add_special_tokens=False).ids, text[:40]


def test_first_fit_against_plain_scan():
    rng = np.random.default_rng(1)
    for capacity in (7, 100, 2048):
        lengths = sorted(rng.integers(1, capacity + 1, 200).tolist(), reverse=True)
        room, want = [], []
        for n in lengths:
            k = next((i for i, r in enumerate(room) if r >= n), len(room))
            if k == len(room):
                room.append(capacity)
            want.append((k, capacity - room[k]))
            room[k] -= n
        assert packing.first_fit_decreasing(lengths, capacity) == want


@pytest.fixture(scope="module")
def packed(documents):
    return packing.pack(packing.cut(documents, with_ids=True), group_pieces=20).collect()


def test_every_id_once(documents, packed):
    slow = Tokenizer.from_file(packing.default_vocabulary())
    want = sorted((str(r["doc_id"]), tuple([*slow.encode(r["text"] or "", add_special_tokens=False).ids, 1])) for r in documents.collect())
    pieces = sorted(packed, key=lambda r: (str(r["doc_id"]), r["doc_tokens"], r["start"]))
    assert sum(r["length"] for r in pieces) == sum(len(ids) for _, ids in want)
    by_doc = {}
    for r in pieces:
        by_doc.setdefault((str(r["doc_id"]), r["doc_tokens"]), {}).setdefault(r["start"], []).append(bytes(r["ids"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for doc, ids in want:
        parts = by_doc[doc, len(ids)]
        raw = np.array(ids, "<u4").tobytes()
        assert all(raw[4 * a : 4 * a + len(p)] in by_doc[doc, len(ids)][a] for a in parts for p in parts[a][:1])


def test_sequences_are_gapless(packed):
    groups = {}
    for r in packed:
        groups.setdefault(r["sequence_id"], []).append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: r["offset"])
        at = 0
        for r in rows:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and all(r["sequence_tokens"] == at for r in rows)
        assert rows[0]["padding"] == (0 if at & (at - 1) == 0 else 2048 - at)


def test_sequences_hold_the_ids(documents):
    packed = packing.pack(packing.cut(documents, with_ids=True))
    joined = packing.sequences(packed)
    assert joined.select(F.sum(F.length("ids"))).first()[0] == 4 * packed.select(F.sum("length")).first()[0]
    assert joined.where(F.length("ids") > 4 * 2048).count() == 0


def test_empty_table(empty):
    assert packing.pack(packing.cut(empty)).count() == 0


def test_repeated_rows_spread_over_groups(spark):
    rows = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    dealt = packing.pack(packing.cut(rows), group_pieces=100)
    assert "row" not in dealt.columns
    sizes = [r["count"] for r in dealt.groupBy(F.shiftright("sequence_id", 32)).count().collect()]
    assert sum(sizes) == 2000 and len(sizes) == 21 and max(sizes) < 200
