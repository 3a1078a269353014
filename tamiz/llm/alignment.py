"""Cross-tokenizer alignment: where the tokens of two vocabularies end at the same byte of a text.

The two lists of token ends of a document are intersected by galloping: each end of the shorter list is looked
for in the longer one by an exponential search from where a neighbour was found, and a binary search in what
that leaves. The common ends cut both token lists into groups; differences of their ranks are the groups' ranges.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, map_batches, utf8_bytes
from tamiz.llm.packing import PLAIN, WORDS, _bytes_of_characters
from tamiz.session import scratch_path

SPACE = b" "
#: Bytes of text that a worker aligns at once, unless one text alone is longer.
CHUNK_BYTES = 1 << 20
STATE = """kind int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary,
a_id int, b_id int, n long"""
DETAILS = "a_ids array<int>, b_ids array<int>, groups array<struct<a_end:int,b_end:int,byte_end:long>>"


@dataclass
class Vocabulary:
    """What the ids of a tokenizer stand for: their bytes, the lengths of these, and decimals with room for a mark."""

    tokens: list[bytes]

    def __post_init__(self):
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        seen: dict[bytes, int] = {}
        #: Which of the ids with the same bytes this is.
        self.copy = np.array([seen.__setitem__(t, seen.get(t, -1) + 1) or seen[t] for t in self.tokens], np.int64)
        self.copies = int(self.copy.max(initial=0)) + 1
        digits = len(str(len(self.tokens)))
        texts = [str(i).encode().ljust(digits + 1, b"\0") for i in range(len(self.tokens))]
        self.decimals = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, digits + 1)
        self.digits = (self.decimals > 0).sum(1)


class ByteLevel:
    """Ids by a byte-level vocabulary file; special tokens inside a text are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["id"]: t["content"].encode() for t in described.get("added_tokens", [])}
        byte = _bytes_of_characters()
        tokens = {i: bytes(byte[c] for c in token) for token, i in described["model"]["vocab"].items() if i not in special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks={t: i for i, t in tokens.items()}, special_tokens={})
        known = tokens | special
        self.vocabulary = Vocabulary([known.get(i, b"") for i in range(max(known) + 1)])

    def __call__(self, texts: list[str]) -> list[list[int]]:
        # see packing.PLAIN: of these characters both libraries make the same words
        return [self.fast.encode_ordinary(t) if PLAIN.fullmatch(t) else self.slow.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """Ids by a subword model, which puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.vocabulary = Vocabulary(
            [bytes([int(n[3:-1], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        )

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the increasing numbers ``short`` the first place in ``long`` that holds no less.

    Every second number is looked for from the place of the one before it, which was found with the numbers of twice
    its stride: steps of 1, 2, 4, ... until they pass it, then a binary search between the last two steps.
    The place of the number after it bounds the steps. All numbers of a stride take their steps together."""
    place = np.zeros(len(short), np.int64)
    stride = 1 << max(0, len(short) - 1).bit_length()
    at = np.zeros(min(1, len(short)), np.int64)
    low, cap = np.zeros(len(at), np.int64), np.full(len(at), len(long), np.int64)
    while len(at):
        place[at] = _between(short[at], long, low, cap)
        stride //= 2
        while stride and stride >= len(short):
            stride //= 2
        if not stride:
            break
        at = np.arange(stride, len(short), 2 * stride)
        after = at + stride
        low = place[at - stride]
        cap = np.where(after < len(short), place[np.minimum(after, len(short) - 1)], len(long))
    return place


def _between(wanted: np.ndarray, long: np.ndarray, low: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """First places in ``[low, cap]`` of ``long`` with no less than ``wanted``; ``cap`` if there is none before it."""
    low, high, step = low.copy(), low.copy(), 1
    going = np.flatnonzero(high < cap)
    while len(going):
        below = going[long[high[going]] < wanted[going]]
        low[below] = high[below] + 1
        high[below] = np.minimum(high[below] + step, cap[below])
        going = below[high[below] < cap[below]]
        step *= 2
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        below = long[middle] < wanted[going]
        low[going[below]] = middle[below] + 1
        high[going[~below]] = middle[~below]
        going = going[low[going] < high[going]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray, a_drives: np.ndarray, b_drives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of equal numbers in two increasing lists. ``a_drives`` marks the numbers of ``a`` that belong to
    documents whose list in ``a`` is no longer than that in ``b``, ``b_drives`` those of ``b`` in all other documents."""
    ranks = []
    for short, long, drives in ((a, b, a_drives), (b, a, b_drives)):
        mine = np.flatnonzero(drives)
        place = gallop(short[mine], long)
        inside = place < len(long)
        mine, place = mine[inside], place[inside]
        equal = long[place] == short[mine]
        ranks.append((mine[equal], place[equal]))
    (a1, b1), (b2, a2) = ranks
    in_order = np.argsort(np.r_[a1, a2], kind="stable")
    return np.r_[a1, a2][in_order], np.r_[b1, b2][in_order]


@dataclass
class Aligned:
    """A chunk of documents, their tokens one after the other; ``of_a``, ``of_b`` and ``of_group`` start each document's part."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    of_a: np.ndarray
    of_b: np.ndarray
    #: ranks of the tokens that close a group, and the byte of the document at which they end
    last_a: np.ndarray
    last_b: np.ndarray
    ends: np.ndarray
    of_group: np.ndarray


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(counts)].astype(np.int64)


def align_texts(raw: list[bytes], byte_level: ByteLevel, pieces: Pieces) -> Aligned:
    """Tokens and groups of each text. A text that is empty, or that a tokenizer does not give back byte for byte after
    a space, has none."""
    texts = [r.decode("utf-8", "replace") for r in raw]
    used = [i for i, r in enumerate(raw) if r]
    found_a = byte_level([" " + texts[i] for i in used])
    found_b = pieces([texts[i] for i in used])
    lists_a, lists_b = [[] for _ in raw], [[] for _ in raw]
    bytes_a, bytes_b = byte_level.vocabulary.tokens.__getitem__, pieces.vocabulary.tokens.__getitem__
    for i, a, b in zip(used, found_a, found_b):
        whole = SPACE + raw[i]
        if b"".join(map(bytes_a, a)) == whole and b"".join(map(bytes_b, b)) == whole:
            lists_a[i], lists_b[i] = a, b
    n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (lists_a, lists_b))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(lists), np.int32, int(n.sum())) for lists, n in ((lists_a, n_a), (lists_b, n_b)))
    of_a, of_b = _starts(n_a), _starts(n_b)
    # tokens of all documents lie one behind the other, so do their bytes
    ends_a, ends_b = np.cumsum(byte_level.vocabulary.lengths[ids_a]), np.cumsum(pieces.vocabulary.lengths[ids_b])
    a_short = n_a <= n_b
    last_a, last_b = common_ends(ends_a, ends_b, np.repeat(a_short, n_a), np.repeat(~a_short, n_b))
    size = np.array([len(r) + 1 if n else 0 for r, n in zip(raw, n_a)], np.int64)
    doc = np.repeat(np.arange(len(raw)), n_a)[last_a]
    return Aligned(ids_a, ids_b, of_a, of_b, last_a, last_b, ends_a[last_a] - _starts(size)[doc], np.searchsorted(last_a, of_a))


def group_texts(found: Aligned, a: Vocabulary, b: Vocabulary) -> list[bytes]:
    """Of each document ``a1,a2|b1;a3|b2,b3``: the ids of its groups in decimals."""
    total = len(found.ids_a) + len(found.ids_b)
    rows = np.zeros((total, max(a.decimals.shape[1], b.decimals.shape[1])), np.uint8)
    closes_a, closes_b = np.zeros(len(found.ids_a), bool), np.zeros(len(found.ids_b), bool)
    closes_a[found.last_a], closes_b[found.last_b] = True, True
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    # before a token of A come the tokens of B in earlier groups; before one of B those of A up to its own group
    at_a = np.arange(len(found.ids_a)) + np.r_[0, found.last_b + 1][group_a]
    at_b = np.arange(len(found.ids_b)) + (found.last_a + 1)[group_b]
    for ids, at, closes, words, mark in ((found.ids_a, at_a, closes_a, a, b"|"), (found.ids_b, at_b, closes_b, b, b";")):
        rows[at, : words.decimals.shape[1]] = words.decimals[ids]
        rows[at, words.digits[ids]] = np.where(closes, ord(mark), ord(b","))
    used = rows > 0
    flat = rows[used].tobytes()
    cuts = _starts(used.sum(1))[found.of_a + found.of_b].tolist()
    return [flat[start : end - 1] if end > start else b"" for start, end in zip(cuts, cuts[1:])]


class PairPlaces:
    """A place for each pair of ids that can ever end together, without a table of them.

    Of two tokens that end at the same byte the shorter is the tail of the longer, so a pair is known by the longer
    token and the length of the shorter. There are as many places as both vocabularies have bytes (twice where ids
    share their bytes), whatever the corpus: about a million here, which bounds every count of pairs below."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b, self.copies = a, b, max(a.copies, b.copies)
        self.of_a = _starts(a.lengths)
        self.of_b = _starts(b.lengths) + self.of_a[-1]
        self.total = int(self.of_b[-1]) * self.copies

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        long_a, long_b = self.a.lengths[a], self.b.lengths[b]
        within_a = (self.of_a[a] + long_b - 1) * self.copies + self.b.copy[b]
        within_b = (self.of_b[b] + long_a - 1) * self.copies + self.a.copy[a]
        return np.where(long_b <= long_a, within_a, within_b)


def _chunks(docs: list, raw: list[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    start, held = 0, 0
    for i, r in enumerate(raw):
        if i > start and held + len(r) > CHUNK_BYTES:
            yield docs[start:i], raw[start:i]
            start, held = i, 0
        held += len(r)
    if raw:
        yield docs[start:], raw[start:]


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values, kind))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def token_groups(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """(doc_id, a_ids, b_ids, groups) of each row of ``docs``: ids by both vocabularies, and for each group the rank behind
    its last token in either list and the byte behind it, counted with the space before the text.

    A group starts where the one before it ends. Texts without tokens (see :func:`align_texts`) have empty lists."""
    default = default_vocabularies()

    def read(batches: Batches) -> Batches:
        left, right = ByteLevel(byte_level or default[0]), Pieces(pieces or default[1])
        for batch in batches:
            for ids, raw in _chunks(batch.column("doc_id").to_pylist(), utf8_bytes(batch.column("text"))):
                found = align_texts(raw, left, right)
                doc = np.repeat(np.arange(len(raw)), np.diff(found.of_group))
                group = pa.StructArray.from_arrays(
                    [pa.array(x, t) for x, t in ((found.last_a + 1 - found.of_a[doc], pa.int32()), (found.last_b + 1 - found.of_b[doc], pa.int32()), (found.ends, pa.int64()))],
                    names=["a_end", "b_end", "byte_end"],
                )
                groups = pa.ListArray.from_arrays(pa.array(found.of_group.astype(np.int32)), group)
                columns = [pa.array(ids, pa.int64()), _lists(found.ids_a, found.of_a, pa.int32()), _lists(found.ids_b, found.of_b, pa.int32()), groups]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "b_ids", "groups"])

    return map_batches(_rows(docs), read, f"doc_id long, {DETAILS}")


def _first_pass(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """One row per document (kind 0) with the places of its linked pairs, and from each task how often it met
    each pair of ids (kind 1)."""
    names = [f.split()[0] for f in STATE.split(",")]

    def read(batches: Batches) -> Batches:
        left, right = ByteLevel(byte_level), Pieces(pieces)
        places = PairPlaces(left.vocabulary, right.vocabulary)
        counts = np.zeros(places.total, np.int64)
        pair_a, pair_b = np.zeros(places.total, np.int32), np.zeros(places.total, np.int32)
        for batch in batches:
            for ids, raw in _chunks(batch.column("doc_id").to_pylist(), utf8_bytes(batch.column("text"))):
                found = align_texts(raw, left, right)
                a, b = found.ids_a[found.last_a], found.ids_b[found.last_b]
                linked = places(a, b)
                seen, times = np.unique(linked, return_counts=True)
                counts[seen] += times
                pair_a[linked], pair_b[linked] = a, b
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(found, left.vocabulary, right.vocabulary)]
                flat, cuts = linked.astype("<i4").tobytes(), (4 * found.of_group).tolist()
                n = len(raw)
                columns = [
                    pa.array(np.zeros(n, np.int32)), pa.array(ids, pa.int64()),
                    *(pa.array(np.diff(x)) for x in (found.of_a, found.of_b, found.of_group)), pa.array(digests, pa.string()),
                    pa.array([flat[s:e] for s, e in zip(cuts, cuts[1:])], pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        met = np.flatnonzero(counts)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        columns = [pa.array(np.ones(len(met), np.int32)), *(pa.nulls(len(met), t) for t in kinds), *(pa.array(x[met]) for x in (pair_a, pair_b, counts))]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(_rows(docs), read, STATE)


def pair_counts(state: DataFrame) -> DataFrame:
    """(a_id, b_id, n, best): how many links of the corpus hold a pair, and whether no pair with its B id has more."""
    pairs = state.where("kind = 1").groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))
    most = pairs.groupBy("b_id").agg(F.max("n").alias("most"))
    return pairs.join(most, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_level: str | None = None, pieces: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Per row of ``docs`` (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and :func:`pair_counts`.

    A link is a token of each list that end together, so a document has as many as groups. ``n_best`` counts links
    whose pair is the most frequent of the corpus for its B id, ties included; ``count_sum`` adds up the counts of all links.
    NULL and empty texts, and texts that a tokenizer changes, have no tokens: zeros, and '' for the digest. Very long
    texts are aligned whole; repeated rows and ids are documents of their own; an empty table gives no rows.

    Texts are tokenised once. The links wait in the shared folder, four bytes each, until the counts of pairs are
    known. How many different pairs there can be follows from the vocabularies alone (see :class:`PairPlaces`), so the
    table of counts is sent to all workers whatever the corpus; no row is sent to another one."""
    spark = docs.sparkSession
    default = default_vocabularies()
    paths = byte_level or default[0], pieces or default[1]
    path = scratch_path(spark, "links")
    _first_pass(docs, *paths).write.option("compression", "zstd").parquet(path)
    state = spark.read.schema(STATE).parquet(path)
    pairs = pair_counts(state)
    known = pairs.toArrow()
    places = PairPlaces(ByteLevel(paths[0]).vocabulary, Pieces(paths[1]).vocabulary)
    ids_a, ids_b, n, best = (known.column(c).to_numpy(zero_copy_only=False) for c in ("a_id", "b_id", "n", "best"))
    at = places(ids_a.astype(np.int64), ids_b.astype(np.int64))
    in_order = np.argsort(at)
    at, n, best, total = at[in_order].astype(np.int32), n[in_order].astype(np.int64), best[in_order].astype(bool), places.total

    def count(batches: Batches) -> Batches:
        counts, is_best = np.zeros(total, np.int64), np.zeros(total, np.int64)
        counts[at], is_best[at] = n, best
        for batch in batches:
            parts = batch.column("links").to_pylist()
            linked = np.frombuffer(b"".join(parts), "<i4")
            cuts = _starts(np.array([len(p) // 4 for p in parts], np.int64))
            sums = [np.r_[0, np.cumsum(x[linked])] for x in (is_best, counts)]
            added = [pa.array(s[cuts[1:]] - s[cuts[:-1]]) for s in sums]
            names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *added], names=[*names, "n_best", "count_sum"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long"
    documents = state.where("kind = 0").select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links")
    counted = map_batches(documents, count, schema)
    columns = ["doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"]
    return counted.select(*columns), pairs
