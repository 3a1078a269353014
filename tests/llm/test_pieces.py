import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tamiz.llm import pieces

PATH = pieces.default_vocabulary()


@pytest.fixture(scope="module")
def texts(corpus):
    return [t or "" for _, t, *_ in corpus] + ["  two  spaces \n", "tab\tend ", "x" * 500 + "yz" * 300, "ÀÉ naïve Straße", "\x00\x1f", "͸"]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_without_dropout_as_the_library(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    encoder = pieces.PieceEncoder(PATH, 0.0)
    for text, found in zip(texts, encoder.encode(texts, [0] * len(texts))):
        if pieces.MARK not in text:  # the library reads a literal mark as a space
            assert ids(found) == model.encode(text), text[:30]


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6, 1.0])
def test_lossless(texts, rate):
    encoder = pieces.PieceEncoder(PATH, rate, seed=9)
    for text, found in zip(texts, encoder.encode(texts, range(len(texts)))):
        assert encoder.decode(found) == text
    if rate == 1.0:  # every merge is skipped
        assert len(ids(encoder.encode(["river"], [0])[0])) == 6


def test_seeds_and_places_vary(texts):
    text = ["stone bridge over the river " * 20]
    first, again, other = (pieces.PieceEncoder(PATH, 0.3, seed=s).encode(text, [5])[0] for s in (1, 1, 2))
    assert first == again != other
    words = pieces.PieceEncoder(PATH, 0.3, seed=1)
    cuts = {tuple(ids(words.encode(["bridge"], [d])[0])) for d in range(40)}
    assert len(cuts) > 1


def test_many_units_as_the_agenda():
    vocabulary, rng = pieces.Vocabulary(PATH), random.Random(7)
    units = ["".join(rng.choice("aeinrst ") for _ in range(rng.randrange(1, 12))) for _ in range(300)] + ["é" * 3, "日本", "in" * 40]
    table = [vocabulary.characters[np.array([ord(c) for c in u])] for u in units]
    keys = np.array([rng.getrandbits(64) for _ in units], np.uint64)
    for rate in (0.0, 0.4):
        flat, counts = pieces.merge_units(vocabulary, np.concatenate(table), np.array([len(t) for t in table]), keys, rate)
        at = 0
        for t, key, n in zip(table, keys.tolist(), counts.tolist()):
            assert flat[at : at + n].tolist() == pieces.agenda(vocabulary, t.tolist(), key, rate)
            at += n


def test_cache_does_not_matter(texts):
    small = pieces.PieceEncoder(PATH, 0.2, seed=3, cache=10)
    large = pieces.PieceEncoder(PATH, 0.2, seed=3)
    for i, text in enumerate(texts):
        assert small.encode([text], [i]) == large.encode([text], [i])


def test_every_occurrence_draws(texts):
    text = "understanding " * 3000
    encoder = pieces.PieceEncoder(PATH, 0.3, seed=1)
    vocabulary = encoder.vocabulary
    places = [encoder.encode([text], [d])[0] for d in (1, 2)]
    cuts, pieces_of = set(), []
    for raw in places:
        at, names = [], [vocabulary.names[i] for i in ids(raw)]
        for i, name in enumerate(names):
            if name.startswith(pieces.MARK):
                at.append(i)
        pieces_of.append([tuple(names[a:b]) for a, b in zip(at, [*at[1:], len(names)])])
        cuts |= set(pieces_of[-1])
    assert len(cuts) > 50  # the number grows with the occurrences
    assert pieces_of[0] != pieces_of[1]
    # a text without spaces is cut anew in each document
    assert len({encoder.encode(["abcdefgh" * 30], [d])[0] for d in range(20)}) == 20


@pytest.mark.parametrize("rate", [0.1, 0.5])
def test_kept_cuts_as_the_agenda(texts, rate, monkeypatch):
    kept = pieces.PieceEncoder(PATH, rate, seed=4).encode(texts, range(len(texts)))
    monkeypatch.setattr(pieces, "STEPS", 0)  # whatever skips is merged on its own
    assert pieces.PieceEncoder(PATH, rate, seed=4).encode(texts, range(len(texts))) == kept


def test_tables(documents, empty):
    encoded = pieces.encode_documents(documents.withColumn("ids", F.lit(1)))
    back = pieces.decode_documents(encoded).select("doc_id", "text").collect()
    want = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert sorted(map(str, back)) == sorted(map(str, want))
    trips = pieces.round_trips(documents.withColumn("ids", F.lit(1))).collect()
    stored = {(r["doc_id"], len(r["ids"]) // 4, zlib.crc32(bytes(r["ids"]))) for r in encoded.collect()}
    assert {(r["doc_id"], r["n_pieces"], r["ids_crc32"]) for r in trips} == stored
    assert sorted(r["decoded_sha256"] for r in trips) == sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in want)
    assert pieces.round_trips(empty).count() == pieces.encode_documents(empty).count() == 0
