"""Line deduplication as an exact set-similarity join.

A line is the set of its words. Words are ordered by rarity in the whole corpus; two lines with Jaccard
similarity 0.8 or more share a word among the rarest few of each (the prefix). Lines meet at those words,
length, position and a parity signature rule most pairs out without loss, and the full sets decide. A line
goes if an earlier line (by document, then line number) is as similar, or the same.

Work is moved in packed blocks of fixed-width records, a few per task and bucket, not row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import CHUNK, Batches, key_filter, map_batches, runs, ship
from tamiz.session import materialise

#: Similarity as a fraction, so that all bounds are whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
RARITY_BUCKETS = 1 << 20
RARITY_BLOCK = 1 << 14
CHUNK_BYTES = 1 << 21
FLUSH_BYTES = 1 << 23
PAIRS_AT_ONCE = 1 << 20
PAIRS_IN_MIND = 1 << 16  # compared at a time, few enough for the caches
#: Sizes of lines in bands, for marks of words: each band starts a sixth above the one before, or one word.
BANDS = np.unique([int((7 / 6) ** i) for i in range(140)])
SHIFTS = (0, 16, 32)  # bits of a key at which its places in a bitmap begin
LAST_ID = (1 << 63) - 1
ONCE = 8  # rarity of a bucket that counts one occurrence

POSTING = np.dtype([("token", "<u4"), ("position", "<u4"), ("size", "<u4"), ("line", "<u4"), ("row", "<u4"), ("doc", "<i8"), ("even", "<u8"), ("odd", "<u8")])
SAME = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("line", "<u4")])


def overlap_needed(a, b):
    """Fewest common words of sets of ``a`` and ``b`` words that reach the similarity."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def prefix_length(n):
    return n - -(-NUMERATOR * n // DENOMINATOR) + 1


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (salt + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def word_hashes(raw: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, 64-bit hash) of each word of several texts that lie end to end in ``raw``.

    Words are read eight bytes at a time, all words at once."""
    inside = (raw != 32) & (raw - np.uint8(9) > 4)
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = text_starts[(text_starts > 0) & (text_starts < len(raw))]
    begins[cut] = inside[cut]
    closes[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    left = np.flatnonzero(closes) + 1 - starts
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw | ((raw - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))
    eights = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    hashes = mixed((eights[starts] & _KEEP[np.minimum(left, 8)]) + left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    at = 8
    longer = np.flatnonzero(left > at)
    while len(longer):
        more = eights[starts[longer] + at] & _KEEP[np.minimum(left[longer] - at, 8)]
        hashes[longer] = mixed(hashes[longer] ^ mixed(more, 6))
        at += 8
        longer = longer[left[longer] > at]
    return starts, hashes


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, bytes, starts of documents) of stretches of a batch of about ``CHUNK_BYTES``."""
    column = batch.column("text")
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + CHUNK_BYTES, side="right")) - 1)
        yield first, raw[ends[first] : ends[last]], ends[first:last] - ends[first]
        first = last


def line_breaks(raw: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, document, number) of the lines of a chunk. An empty last line of a text is left out."""
    breaks = np.union1d(doc_starts[doc_starts < len(raw)], np.flatnonzero(raw == 10) + 1)
    doc = np.searchsorted(doc_starts, breaks, side="right") - 1
    return breaks, doc, np.arange(len(breaks)) - np.searchsorted(breaks, doc_starts)[doc]


class Lines:
    """The lines with words of a chunk: document (within the chunk), number, and distinct words in order:
    by rarity then hash, or by hash alone."""

    def __init__(self, raw: np.ndarray, doc_starts: np.ndarray, rarity: np.ndarray | None):
        starts, hashes = word_hashes(raw, doc_starts)
        breaks, doc, number = line_breaks(raw, doc_starts)
        sizes = np.diff(np.r_[np.searchsorted(starts, breaks), len(starts)])
        of_word = np.repeat(np.arange(len(breaks), dtype=np.uint64), sizes)
        if rarity is None:
            order = np.lexsort((hashes, of_word))
        else:
            rare = rarity[bucket_of(hashes)].astype(np.uint64) << np.uint64(24)
            key = (of_word << np.uint64(32)) | rare | (hashes << np.uint64(20) >> np.uint64(40))
            order = np.argsort(key)
            key = key[order]
            close = np.flatnonzero(key[1:] == key[:-1])
            if (hashes[order[close]] != hashes[order[close + 1]]).any():
                # prefixes need one order of words in all lines: words that are equal so far go by their whole hash
                order = order[np.lexsort((hashes[order], key))]
        hashes = hashes[order]  # words stay within their line, so ``of_word`` is in order as it is
        new = np.ones(len(hashes), bool)
        new[1:] = (of_word[1:] != of_word[:-1]) | (hashes[1:] != hashes[:-1])
        of_word, self.words = of_word[new].astype(np.int64), hashes[new]
        self.first, self.size = runs(of_word)
        line = of_word[self.first]
        self.doc, self.number = doc[line], number[line]

    def some(self, chosen: np.ndarray) -> Lines:
        """The chosen lines alone."""
        few = object.__new__(Lines)
        few.size, few.doc, few.number = self.size[chosen], self.doc[chosen], self.number[chosen]
        few.first = np.cumsum(few.size) - few.size
        few.words = self.words[np.arange(few.size.sum()) + np.repeat(self.first[chosen] - few.first, few.size)]
        return few

    def reduce(self, operation, values: np.ndarray) -> np.ndarray:
        return operation.reduceat(values, self.first) if len(self.first) else np.zeros(0, values.dtype)


def bucket_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - RARITY_BUCKETS.bit_length() + 1)).astype(np.int64)


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, row, text): NULL texts empty, rows without id last, and a hash that tells rows of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), row.alias("row"), text.alias("text"))


def _count_words(batches: Batches) -> Batches:
    counts = np.zeros(RARITY_BUCKETS, np.int64)
    for batch in batches:
        found = [bucket_of(word_hashes(raw, starts)[1]).astype(np.int32) for _, raw, starts in chunks(batch)]
        if found:
            counts += np.bincount(np.concatenate(found), minlength=RARITY_BUCKETS)
    if counts.any():
        blocks = counts.reshape(-1, RARITY_BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([b.tobytes() for b in blocks], pa.binary())], ["block", "counts"])


def _add_blocks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(b, np.int64) for b in table.column("counts").to_pylist())
    return pa.table([table.column("block")[:1], pa.array([total.tobytes()], pa.binary())], ["block", "counts"])


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of words over all documents, in a fixed number of buckets (8 MB, whatever the corpus)."""
    ship(docs.sparkSession)
    schema = "block int, counts binary"
    blocks = map_batches(docs.select("text"), _count_words, schema).groupBy("block").applyInArrow(_add_blocks, schema).collect()
    counts = np.zeros(RARITY_BUCKETS, np.int64)
    for block, part in blocks:
        counts[block * RARITY_BLOCK : (block + 1) * RARITY_BLOCK] = np.frombuffer(part, np.int64)
    return counts


def _dealt(records: np.ndarray, chosen: np.ndarray, cells: np.ndarray, kind: int) -> Iterator[tuple[int, int, bytes]]:
    """The chosen records by their cells."""
    order = np.argsort(cells)
    records, cells = records[chosen[order]], cells[order]
    for start, length in zip(*runs(cells)):
        yield kind, int(cells[start]), records[start : start + length].tobytes()


def _repeats(same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records in order, which of them repeat the set of an earlier line, and the order. Rows repeated as a whole have
    the same lines, which are one line rather than an earlier and a later one."""
    order = np.lexsort((same["line"], same["row"], same["doc"], same["two"], same["one"]))
    same = same[order]
    again = np.zeros(len(same), bool)
    again[1:] = (same["one"][1:] == same["one"][:-1]) & (same["two"][1:] == same["two"][:-1])
    leader = np.maximum.accumulate(np.where(again, 0, np.arange(len(same))))
    again &= line_keys(same) != line_keys(same[leader])
    return same, again, order


def _cell(bucket, ways, low, high):
    return (bucket << 24) | (ways << 16) | (low << 8) | high


def _part(records: np.ndarray, ways) -> np.ndarray:
    return (mixed(line_keys(records), 4) % np.asarray(ways).astype(np.uint64)).astype(np.int64)


def _emit(rarity: np.ndarray, split: np.ndarray, buckets: int, words_of: np.ndarray | None):
    """Blocks of records: kind 0 to find equal sets, kind 1 the postings of prefixes, kind 2 lines settled here.

    ``split`` says, for each rarity bucket, into how many parts the postings of its words are dealt; a posting
    goes to every cell (own part, other part), so that any two of a word meet in exactly one cell. A word that occurs once
    meets no other. ``words_of``: in a second round, marks of the words that lines still open have in their prefixes, with
    the bands of sizes of lines that may match them; no other posting can matter."""

    def records(lines: Lines, doc_id: np.ndarray, row_of: np.ndarray) -> tuple[np.ndarray, ...]:
        taken = np.where(lines.size >= NUMERATOR, prefix_length(lines.size), 0)
        line = np.repeat(np.arange(len(taken)), taken)
        position = np.arange(len(line)) - np.repeat(np.cumsum(taken) - taken, taken)
        words = lines.words[lines.first[line] + position]
        wanted = rarity[bucket_of(words)] != ONCE
        if words_of is not None:
            wanted &= marked(words_of, sized(words, lines.size[line]))
        line, position, words = line[wanted], position[wanted], words[wanted]
        if words_of is not None:
            chosen, line = np.unique(line, return_inverse=True)
            lines = lines.some(chosen)
        doc, row = doc_id[lines.doc], row_of[lines.doc].astype(np.uint32)
        same = np.zeros(len(doc), SAME)
        same["one"], same["two"] = (lines.reduce(np.add, mixed(lines.words, salt)) for salt in (1, 2))
        same["doc"], same["row"], same["line"] = doc, row, lines.number
        bit = np.uint64(1) << (lines.words & np.uint64(63))
        odd = (lines.words & np.uint64(64)) > 0
        parity = [lines.reduce(np.bitwise_xor, np.where(side, bit, np.uint64(0))) for side in (~odd, odd)]
        posting = np.zeros(len(line), POSTING)
        posting["token"] = words & np.uint64(0xFFFFFFFF)
        posting["position"], posting["size"] = position, lines.size[line]
        posting["even"], posting["odd"] = parity[0][line], parity[1][line]
        posting["line"], posting["row"], posting["doc"] = lines.number[line], row[line], doc[line]
        return same, posting, words, line

    def blocks(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        before = np.cumsum([0] + [len(part[0]) for part in parts]).tolist()
        line = np.concatenate([part[3] + n for part, n in zip(parts, before)])
        same, postings, words = (np.concatenate([part[k] for part in parts]) for k in range(3))
        same, again, order = _repeats(same)
        repeated = np.empty(len(same), bool)
        repeated[order] = again
        out = []
        if words_of is None:
            if again.any():
                out.append((2, int(same["one"][0] % np.uint64(buckets)), same[again].tobytes()))
            out += _dealt(same, np.flatnonzero(~again), (same["one"][~again] % np.uint64(buckets)).astype(np.int64), 0)
        fresh = np.flatnonzero(~repeated[line])
        words = words[fresh]
        bucket = (mixed(words, 3) % np.uint64(buckets)).astype(np.int64)
        ways = split[bucket_of(words)].astype(np.int64)
        whole = ways == 1
        out += _dealt(postings, fresh[whole], _cell(bucket[whole], 1, 0, 0), 1)
        postings, bucket, ways = postings[fresh[~whole]], bucket[~whole], ways[~whole]
        copies = np.repeat(np.arange(len(postings)), ways)
        other = np.arange(len(copies)) - np.repeat(np.cumsum(ways) - ways, ways)
        part = _part(postings, ways)[copies]
        cell = _cell(bucket[copies], ways[copies], np.minimum(part, other), np.maximum(part, other))
        out += _dealt(postings, copies, cell, 1)
        kinds, keys, blobs = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["kind", "cell", "records"])

    def emit(batches: Batches) -> Batches:
        for batch in batches:
            doc_id, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
            parts, read = [], 0
            for first, raw, starts in chunks(batch):
                lines = Lines(raw, starts, rarity)
                parts.append(records(lines, doc_id[first:], row[first:]))
                read += len(raw)
                if read >= FLUSH_BYTES:
                    yield blocks(parts)
                    parts, read = [], 0
            if parts:
                yield blocks(parts)

    return emit


def line_keys(records: np.ndarray) -> np.ndarray:
    """A 64-bit name of a line of a row."""
    key = mixed(records["doc"].astype(np.uint64)) ^ mixed((records["row"].astype(np.uint64) << np.uint64(32)) | records["line"].astype(np.uint64), 5)
    return mixed(key)


class Postings:
    """Postings of a cell as columns, by word, then size of the line. ``line`` numbers the lines in their order."""

    def __init__(self, records: np.ndarray):
        key = records["token"].astype(np.uint64) << np.uint64(32) | records["size"]
        order = np.argsort(key)
        token, size = key[order] >> np.uint64(32), (key[order] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # sizes are in order, so a posting that matches neither neighbour in size matches none
        met = (token[1:] == token[:-1]) & (DENOMINATOR * size[:-1] >= NUMERATOR * size[1:])
        records = records[order[np.r_[met, False] | np.r_[False, met]]] if len(met) else records[:0]
        self.records, self.token = records, records["token"].copy()
        self.size, self.position = (records[c].astype(np.int64) for c in ("size", "position"))
        self.even, self.odd = records["even"].copy(), records["odd"].copy()
        keys = line_keys(records)
        order = np.argsort(keys)
        starts, lengths = runs(keys[order])
        first, number = order[starts], np.empty(len(order), np.int64)
        number[order] = np.repeat(np.arange(len(starts)), lengths)
        some = records[first]
        place = np.empty(len(first), np.int64)
        place[np.lexsort((some["line"], some["row"], some["doc"]))] = np.arange(len(first))
        self.line = place[number]
        self.record_of = np.empty(len(first), np.int64)
        self.record_of[place] = first

    def pairs(self, cell: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, differing parities) of postings of one word that may match. By word and size in order, the partners of a
        posting follow it up to the largest size that still allows a match; then parities, then positions rule pairs out.

        None of this loses a pair: two sets that differ in ``k`` words differ in at most ``k`` bits of the
        parities of their words' hashes."""
        ways, low, high = cell >> 16 & 255, cell >> 8 & 255, cell & 255
        part = _part(self.records, ways) if low != high else None
        word, largest = self.token.astype(np.uint64) << np.uint64(32), self.size * DENOMINATOR // NUMERATOR
        ends = np.searchsorted(word | self.size.astype(np.uint64), word | largest.astype(np.uint64), side="right")
        partners = ends - np.arange(1, len(word) + 1)
        before = np.r_[0, np.cumsum(partners)]
        at, size = 0, self.size.astype(np.int32)
        while at < len(word):
            last = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS_IN_MIND, side="right")) - 1)
            some = partners[at:last]
            i = np.repeat(np.arange(at, last), some)
            j = np.arange(1, len(i) + 1) + i - np.repeat(before[at:last] - before[at], some)
            at = last
            differ = np.bitwise_count(self.even[i] ^ self.even[j]) + np.bitwise_count(self.odd[i] ^ self.odd[j])
            both = size[i] + size[j]
            good = np.flatnonzero(differ <= both - 2 * -(-NUMERATOR * both // (NUMERATOR + DENOMINATOR)))
            i, j, differ = i[good], j[good], differ[good]
            a, b, p, q = self.size[i], self.size[j], self.position[i], self.position[j]
            most = np.minimum(p, q) + np.minimum(a - p, b - q)
            fine = (most >= overlap_needed(a, b)) & (self.line[i] != self.line[j])
            if part is not None:
                fine &= part[i] != part[j]
            if fine.any():
                yield i[fine], j[fine], differ[fine].astype(np.int64)


def _nearest(late: np.ndarray, early: np.ndarray, differ: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Each pair of lines once; of each later line the ``most`` partners with the least differing parities."""
    order = np.argsort(late << 32 | early)
    late, early, differ = late[order], early[order], differ[order]
    new = np.ones(len(late), bool)  # lines may meet at several words of the cell
    new[1:] = (late[1:] != late[:-1]) | (early[1:] != early[:-1])
    late, early, differ = late[new], early[new], differ[new]
    order = np.argsort(late << 9 | differ, kind="stable")
    late, early, differ = late[order], early[order], differ[order]
    starts, lengths = runs(late)
    kept = np.arange(len(late)) - np.repeat(starts, lengths) < most
    return late[kept], early[kept], differ[kept]


def _pairs(records: np.ndarray, cell: int, only: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """(later, earlier, differing parities) of a cell: the nearest partner of each line that may have one, or, for
    the lines that ``only`` marks, all partners."""
    postings = Postings(records)
    wanted = None if only is None else well_marked(only, line_keys(postings.records[postings.record_of]))
    most = 1 if only is None else len(records)
    found = (np.zeros(0, np.int64),) * 3
    waiting: list[tuple[np.ndarray, ...]] = []
    size = 0

    def settle() -> None:
        nonlocal found
        found = _nearest(*(np.concatenate(x) for x in zip(found, *waiting)), most)
        waiting.clear()

    for i, j, differ in postings.pairs(cell):
        a, b = postings.line[i], postings.line[j]
        late, early = np.maximum(a, b), np.minimum(a, b)
        if wanted is not None:
            late, early, differ = late[wanted[late]], early[wanted[late]], differ[wanted[late]]
        waiting.append((late, early, differ))
        size += len(late)
        if size > PAIRS_AT_ONCE:
            settle()
            size = 0
    if waiting:
        settle()
    late, early, differ = found
    sides = (postings.records[postings.record_of[x]] for x in (late, early))
    return *sides, differ


def sized(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes of words together with the band of the size of the line they are in."""
    return banded(words, band_of(sizes))


def banded(words: np.ndarray, bands: np.ndarray) -> np.ndarray:
    return mixed(words ^ mixed(bands.astype(np.uint64), 7))


def band_of(sizes) -> np.ndarray:
    return np.searchsorted(BANDS, sizes, side="right")


def marks_of(chunks: list[tuple[int, bytes]], bits: int) -> np.ndarray:
    """The bitmaps of ``common.key_filter`` end to end."""
    found = np.zeros((1 << bits) // 8, np.uint8)
    for chunk, part in chunks:
        found[chunk << CHUNK - 3 : chunk + 1 << CHUNK - 3] = np.frombuffer(part, np.uint8)
    return found


def marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = (keys >> np.uint64(64 - len(marks).bit_length() - 2)).astype(np.int64)
    return (marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def well_marked(marks: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keys that are marked from each of ``SHIFTS`` on, so that hardly any is by chance."""
    found = np.ones(len(keys), bool)
    for shift in SHIFTS:
        found[found] = marked(marks, keys[found] << np.uint64(shift))
    return found


MET = "doc_id long, row long, line long, key long, key2 long, differ long"


def _meet(only: np.ndarray | None):
    """Kinds 0 and 2 to lines that go, kind 1 to pairs to verify."""

    def meet(table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        blobs = b"".join(table.column("records").to_pylist())
        if kind == 1:
            later, earlier, differ = _pairs(np.frombuffer(blobs, POSTING), table.column("cell")[0].as_py(), only)
            partner = line_keys(earlier).view(np.int64)
        else:
            later, partner = np.frombuffer(blobs, SAME), None
            if kind == 0:
                later, again, _ = _repeats(later)
                later = later[again]
            differ = None
        none = pa.nulls(len(later), pa.int64())
        place = [later["doc"], later["row"].astype(np.int64), later["line"].astype(np.int64), line_keys(later).view(np.int64)]
        return pa.table([*place, *(none if x is None else x for x in (partner, differ))], schema=_MET)

    return meet


_MET = pa.schema([(c.split()[0], pa.int64()) for c in MET.split(", ")])


def _sets_of(marks: np.ndarray):
    """(key, words) of the lines whose key is marked."""

    def find(batches: Batches) -> Batches:
        for batch in batches:
            doc_id, row = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
            for first, raw, starts in chunks(batch):
                breaks, doc, number = line_breaks(raw, starts)
                name = np.zeros(len(breaks), SAME)
                name["doc"], name["row"], name["line"] = doc_id[first + doc], row[first + doc], number
                keys = line_keys(name)
                wanted = np.flatnonzero(marked(marks, keys))
                if not len(wanted):
                    continue
                ends = np.r_[breaks[1:], len(raw)][wanted]
                lengths = ends - breaks[wanted]
                offsets = np.cumsum(lengths) - lengths
                # the marked lines alone, end to end, as if each were a text
                lines = Lines(raw[np.arange(lengths.sum()) + np.repeat(breaks[wanted] - offsets, lengths)], offsets, None)
                sets = [lines.words[a : a + n].tobytes() for a, n in zip(lines.first.tolist(), lines.size.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(keys[wanted[lines.doc]].view(np.int64)), pa.array(sets, pa.binary())], ["key", "words"])

    return find


def _verify(batches: Batches) -> Batches:
    """The later lines of pairs, without ``words`` where the sets reach the similarity. Sets are sorted."""
    for batch in batches:
        good = []
        for a, b in zip(batch.column("words").to_pylist(), batch.column("words2").to_pylist()):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
            good.append(DENOMINATOR * both >= NUMERATOR * (len(x) + len(y) - both))
        words = pa.array(batch.column("words").to_pylist(), pa.binary(), mask=np.array(good, bool))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*LINE, "key")), words], [*LINE, "key", "words"])


def _bits_of(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap that marks all keys given, and by chance others; its size follows their number, up to 16 MB."""
    marks, bits = key_filter(keys, F.col(key))
    return marks_of([(r["chunk"], bytes(r["bits"])) for r in marks.collect()], bits)


LINE = ("doc_id", "row", "line")


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, row, line, key, words) for each pair of a stored table: the later line, and its set if the pair does not
    reach the similarity, else NULL."""
    ends = pairs.select("key").unionByName(pairs.select(F.col("key2").alias("key")))
    found = map_batches(docs, _sets_of(_bits_of(ends, "key")), "key long, words binary")
    # rows repeated as a whole have the same lines; both joins read one shuffle of the sets, so texts are read once
    sets = found.groupBy("key").agg(F.first("words").alias("words"))
    sided = pairs.join(sets, "key").join(sets.select(F.col("key").alias("key2"), F.col("words").alias("words2")), "key2")
    wide = sided.select(*LINE, "key", "words", "words2")
    return map_batches(wide, _verify, "doc_id long, row long, line long, key long, words binary")


def _prefix_words(rarity: np.ndarray):
    """Hashes of the words that the given sets have in their prefixes, with each band of sizes of lines that may match the set."""

    def find(batches: Batches) -> Batches:
        for batch in batches:
            lines = [np.frombuffer(x, np.uint64) for x in batch.column("words").to_pylist()]
            keys = []
            for x in lines:
                words = x[np.lexsort((x, x << np.uint64(20) >> np.uint64(40), rarity[bucket_of(x)]))][: prefix_length(len(x))]
                least, most = band_of([-(-NUMERATOR * len(x) // DENOMINATOR), DENOMINATOR * len(x) // NUMERATOR])
                bands = np.arange(least, most + 1)
                keys.append(banded(np.repeat(words, len(bands)), np.tile(bands, len(words))))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(keys)).view(np.int64))], ["key"])

    return find


def later_matches(docs: DataFrame, cell_records: int = 100_000, split_over: int = 1_000_000, most_parts: int = 128) -> DataFrame:
    """(doc_id, row, line): the lines of ``identified`` rows that an earlier line matches.

    Lines are split at line feeds and numbered from 0; words are runs without ASCII white space, A-Z lower-cased.
    A line without words neither goes nor matches. Order is by doc_id (none: last), a hash of the text for rows of one
    doc_id, then line number. Words are compared by 64-bit hashes. Postings of words with more than
    ``split_over`` occurrences are dealt into up to ``most_parts`` parts that meet pairwise in cells."""
    ship(docs.sparkSession)
    counts = word_counts(docs)
    rarity = np.minimum(255, np.round(8 * np.log2(counts + 1.0))).astype(np.uint8)
    split = np.clip(-(-counts // split_over), 1, most_parts).astype(np.int16)
    buckets = int(max(16, counts.sum() // (4 * cell_records)))

    def meeting(only: np.ndarray | None, words_of: np.ndarray | None) -> DataFrame:
        dealt = map_batches(docs, _emit(rarity, split, buckets, words_of), "kind int, cell long, records binary")
        return materialise(dealt.groupBy("kind", "cell").applyInArrow(_meet(only), MET), "lines-met")

    met = meeting(None, None)
    pairs = met.where(F.col("key2").isNotNull())
    # a line's nearest partner settles nearly all of them
    nearest = pairs.groupBy("key").agg(F.min_by("key2", "differ").alias("key2"), *(F.min(c).alias(c) for c in LINE))
    nearest = materialise(nearest, "line-pairs")
    tried = materialise(_verified(docs, nearest), "lines-tried")
    gone = met.where(F.col("key2").isNull()).unionByName(tried.where(F.col("words").isNull()), allowMissingColumns=True).select(*LINE)
    # the others meet all the lines that share a word of their prefixes
    open_sets = tried.where(F.col("words").isNotNull())
    open_marks = _bits_of(open_sets.select(F.explode(F.array(*(F.shiftleft("key", n) for n in SHIFTS))).alias("key")), "key")
    if open_marks.any():
        words = materialise(map_batches(open_sets.select("words"), _prefix_words(rarity), "key long").distinct(), "open-words")
        rest = meeting(open_marks, _bits_of(words, "key")).where(F.col("key2").isNotNull())
        # lines that are marked by chance are few, and what their pairs say holds as well
        rest = rest.groupBy("key", "key2").agg(*(F.min(c).alias(c) for c in LINE))
        rest = _verified(docs, materialise(rest, "line-pairs")).where(F.col("words").isNull()).select(*LINE)
        gone = gone.unionByName(materialise(rest.distinct(), "lines-gone"))
    return gone


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that an earlier line matches taken out of ``text``; ``n_lines`` and ``n_removed`` added.

    All rows and other columns stay; a text all of whose lines go is empty, a NULL text stays NULL. Columns of the added
    names are replaced, and ``n_chars``, if there, is the length of the new text."""
    own = docs.drop("n_lines", "n_removed")
    gone = later_matches(identified(own)).groupBy("doc_id", "row").agg(F.collect_set("line").alias("__gone"))
    gone = materialise(gone, "lines-of-documents").select(F.col("doc_id").alias("__doc"), F.col("row").alias("__row"), "__gone")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    row = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF))
    joined = own.withColumn("__doc", key).withColumn("__row", row).join(gone.hint("shuffle_hash"), ["__doc", "__row"], "left").drop("__doc", "__row")
    kept_columns = own.columns

    def rewrite(batches: Batches) -> Batches:
        for batch in batches:
            texts, kept, lines, removed = batch.column("text").to_pylist(), [], [], []
            for text, numbers in zip(texts, batch.column("__gone").to_pylist()):
                parts = (text or "").split("\n")
                numbers = set(numbers or ())
                kept.append(text if not numbers else "\n".join(p for i, p in enumerate(parts) if i not in numbers))
                lines.append(len(parts))
                removed.append(len(numbers))
            columns = {n: batch.column(n) for n in kept_columns} | {"text": pa.array(kept, pa.string())}
            if "n_chars" in columns:
                lengths = pa.array([None if t is None else len(t) for t in kept], pa.int64())
                columns["n_chars"] = lengths.cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], [*kept_columns, "n_lines", "n_removed"])

    schema = own.withColumn("n_lines", F.lit(0).cast("long")).withColumn("n_removed", F.lit(0).cast("long")).schema
    return map_batches(joined, rewrite, schema)
