import hashlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer
from sentencepiece import SentencePieceProcessor

from tamiz.llm import alignment
from tamiz.llm.packing import _bytes_of_characters

BYTE, PIECE = alignment.default_vocabularies()


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers, one text at a time, and their tokens' bytes."""
    a, b = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    byte = _bytes_of_characters()

    def piece(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:-1], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        both = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in ids_a], [(i, piece(i)) for i in ids_b]
        whole = (" " + text).encode()
        return both if all(b"".join(t for _, t in x) == whole for x in both) else ([], [])

    return tokens


def ends(tokens):
    out, at = [], 0
    for _, t in tokens:
        at += len(t)
        out.append(at)
    return out


def by_definition(texts, tokens):
    docs, pairs = [], Counter()
    for text in texts:
        a, b = tokens(text)
        ends_a, ends_b = ends(a), ends(b)
        common = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a.index(e)][0], b[ends_b.index(e)][0]) for e in common]
        pairs.update(links)
        groups, low = [], 0
        for e in common:
            groups.append("|".join(",".join(str(i) for (i, _), at in zip(x, where) if low < at <= e) for x, where in ((a, ends_a), (b, ends_b))))
            low = e
        docs.append((len(a), len(b), links, ";".join(groups)))
    most = {}
    for (_, j), n in pairs.items():
        most[j] = max(most.get(j, 0), n)
    return [
        (na, nb, len(links), len(links), sum(pairs[p] == most[p[1]] for p in links), sum(pairs[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "")
        for na, nb, links, text in docs
    ], pairs


AWKWARD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b", "x", " ", "   two  spaces ", "tabs\t\tand\r\n\n\nlines", "naïve café ½ ²³", "日本語のテキスト 한국어", "😀😀 👩‍👩‍👧", "\x00\x01", "ﬁ ﬀ ①", "a" * 3000, "ab " * 5000, "é́", "A B　C D"]


def test_against_definition(spark, corpus, plain):
    rows = [(r[0], r[1]) for r in corpus] + [(1000 + i, t) for i, t in enumerate(AWKWARD)] + [(3, corpus[3][1]), (None, "one row without id")]
    rows = [(i, t if t is None or len(t) < 20_000 else t[:20_000]) for i, t in rows]
    want, pairs = by_definition([t for _, t in rows], plain)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_a", "'clash' AS links", "2 AS kind").repartition(5)
    counted, found = alignment.align(docs)
    got = [tuple(r) for r in counted.collect()]
    assert sorted(got, key=str) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)
    assert {(r["a_id"], r["b_id"]): r["n"] for r in found.collect()} == dict(pairs)
    most = {}
    for (_, j), n in pairs.items():
        most[j] = max(most.get(j, 0), n)
    assert all(r["best"] == (r["n"] == most[r["b_id"]]) for r in found.collect())


def test_groups_give_the_text_back(spark, plain):
    rows = [(i, t) for i, t in enumerate([*AWKWARD, "", None])]
    left, right = alignment.ByteLevel(BYTE).vocabulary.tokens, alignment.Pieces(PIECE).vocabulary.tokens
    for r in alignment.token_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        text = rows[r["doc_id"]][1]
        a, b = plain(text)
        assert (r["a_ids"], r["b_ids"]) == ([i for i, _ in a], [i for i, _ in b])
        at_a = at_b = 0
        whole = b""
        for g in r["groups"]:
            part = b"".join(left[i] for i in r["a_ids"][at_a : g["a_end"]])
            assert part and part == b"".join(right[i] for i in r["b_ids"][at_b : g["b_end"]])
            whole, at_a, at_b = whole + part, g["a_end"], g["b_end"]
            assert len(whole) == g["byte_end"]
        assert whole == ((" " + text).encode() if a else b"") and (at_a, at_b) == (len(a), len(b))


def test_galloping_against_bisection():
    rng = np.random.default_rng(6)
    for n, m in [(0, 0), (0, 5), (5, 0), (1, 1), (1, 1000), (7, 9), (64, 64), (65, 3), (1000, 4000), (3000, 200)]:
        for top in (n + m + 1, 50 * (n + m + 1)):
            short = np.sort(rng.choice(top, n, replace=False)).astype(np.int64)
            long = np.sort(rng.choice(top, m, replace=False)).astype(np.int64)
            assert alignment.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
    far = np.r_[np.arange(500), 10**6 + np.arange(3)]
    assert alignment.gallop(far, np.arange(0, 2 * 10**6, 7)).tolist() == np.searchsorted(np.arange(0, 2 * 10**6, 7), far).tolist()


def test_every_pair_that_can_end_together_has_its_own_place():
    left, right = alignment.ByteLevel(BYTE).vocabulary, alignment.Pieces(PIECE).vocabulary
    places = alignment.PairPlaces(left, right)
    by_bytes = {}
    for j, t in enumerate(right.tokens):
        by_bytes.setdefault(t, []).append(j)
    own = {}
    for i, t in enumerate(left.tokens):
        own.setdefault(t, []).append(i)
    pairs = {(i, j) for i, t in enumerate(left.tokens) for k in range(len(t)) for j in by_bytes.get(t[k:], [])}
    pairs |= {(i, j) for j, t in enumerate(right.tokens) for k in range(len(t)) for i in own.get(t[k:], [])}
    a, b = (np.array(x, np.int64) for x in zip(*pairs))
    found = places(a, b)
    assert len(np.unique(found)) == len(pairs) and found.min() >= 0 and found.max() < places.total


def test_empty_table(spark):
    counted, pairs = alignment.align(spark.createDataFrame([], "doc_id long, text string"))
    assert counted.count() == 0 and pairs.count() == 0
    nothing = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in alignment.align(nothing)[0].collect()) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
