"""Packing documents into token sequences: first-fit decreasing over a tournament tree of capacities.

Documents are dealt into random groups of bounded size; each group packs on its own. Within a group the
pieces come longest first, and the tree finds the first open sequence with room in logarithmic time.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, map_batches, ship, whole_texts
from tamiz.session import materialise

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 8192
#: Texts of these characters only are cut into words alike by both tokenizer libraries, whatever
#: edition of Unicode they carry; any other text goes to the slower one, which defines the ids.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of_characters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: a byte is its own character where that
    prints, and the next free code point above 255 otherwise."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenIds:
    """Ids of whole texts as little-endian unsigned 32-bit integers, after the vocabulary file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"] for t in described.get("added_tokens", [])]
        byte = _bytes_of_characters()
        ranks = {bytes(byte[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: full pieces of ``capacity`` ids, and what is left of each document.

    Every row of ``docs`` is a document of its own, whatever its id; a NULL or empty text is the end id
    alone. ``with_ids`` adds the ids themselves (little-endian 32-bit)."""

    def read(batches: Batches) -> Batches:
        ids_of = TokenIds(vocabulary or default_vocabulary())
        for batch in batches:
            doc, start, length, crc, total, payload = [], [], [], [], [], []
            for d, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.r_[ids_of(text), np.array([end_id], "<u4")].astype("<u4").tobytes()
                size = len(ids) // 4
                for at in range(0, size, capacity):
                    piece = ids[4 * at : 4 * (at + capacity)]
                    doc.append(d)
                    start.append(at)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(size)
                    if with_ids:
                        payload.append(piece)
            columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(payload, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return map_batches(whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id")), read, schema)


class CapacityTree:
    """Capacities of bins as leaves of a tournament: each inner node holds the larger of its children."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> tuple[int, int]:
        """The first bin with room for ``size``, and its room before."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        before = room[node]
        left = node
        room[node] = before - size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return left - self.leaves, before


def first_fit_decreasing(lengths: Iterable[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, in the given order, which has to be decreasing."""
    lengths = list(lengths)
    tree = CapacityTree(len(lengths), capacity)
    placed = (tree.place(n) for n in lengths)
    return [(b, capacity - before) for b, before in placed]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """``pieces`` with ``sequence_id``, ``offset``, ``sequence_tokens`` and ``padding``.

    Groups hold ``group_pieces`` pieces on average, chosen by a hash of document, start and the row's place in the
    stored table, so a document of any length and rows repeated any number of times spread over groups and no
    task's work grows with the table. A sequence is padded to ``capacity``, unless its tokens are a power of two."""
    names, schema = pieces.columns, pieces.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    # stored with its place, so that a task that runs again deals the same rows to the same groups
    pieces = materialise(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = pieces.count() // group_pieces + 1
    spread = F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1)), "start", "ids_crc32", "row")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        length = table.column("length").to_numpy()
        placed = np.array(first_fit_decreasing(length.tolist(), capacity), dtype=np.int64).reshape(-1, 2)
        filled = np.bincount(placed[:, 0], length, minlength=1).astype(np.int64)
        group = table.column("group").to_numpy()
        tokens = filled[placed[:, 0]]
        padding = np.where((tokens & (tokens - 1)) == 0, 0, capacity - tokens)
        added = [(group << 32) + placed[:, 0], placed[:, 1], tokens, padding]
        return pa.table([*(table.column(n) for n in names), *added], [*names, "sequence_id", "offset", "sequence_tokens", "padding"])

    ship(pieces.sparkSession)
    dealt = pieces.withColumn("group", F.pmod(spread, F.lit(groups))).drop("row")
    return dealt.groupBy("group").applyInArrow(fit, f"{schema}, sequence_id long, offset long, sequence_tokens long, padding long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed ids of each sequence, one bounded group per sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts.ids", F.lit(b""), lambda all_ids, x: F.concat(all_ids, x)).alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
    )
