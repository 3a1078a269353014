"""Encoding into subword pieces with seeded merge-dropout, and lossless decoding.

Merges happen best score first, leftmost first among equals, from an agenda of neighbouring symbols; a keyed
hash of a candidate decides whether it is skipped. Without dropout the result is the vocabulary's own
segmentation; with it, one text has as many segmentations as there are seeds, and all decode to it.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Callable
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, map_batches, whole_texts
from tamiz.llm.lines import mixed

MARK = "▁"  # stands for a space in the vocabulary
#: A space always begins a new unit after another character: no piece has a mark behind another character.
UNIT = re.compile(r" *[^ ]+| +")
LONG_UNIT = 64
NO_MERGE = (1 << 31) - 1
ROWS_AT_ONCE = 1 << 14
WIDTHS = np.array([4, 7, 10, 14, 20, 32, LONG_UNIT])  # units up to these sizes are merged together
#: Cuts an occurrence is followed through before it is merged on its own, with the same result.
STEPS = 3
#: Of a cut that has not been made: whether an occurrence needed it before.
NEVER, ONCE = -1, -2

#: Of candidates (row, start, middle, end): which are skipped, and which merges were made.
Skip = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Log = list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


class Vocabulary:
    """Pieces and scores of a byte-pair model, from its public file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(self.size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(self.size)]
        self.bytes_at = {int(n[3:5], 16): i for i, n in enumerate(self.names) if model.is_byte(i)}
        self.ids = {n: i for i, n in enumerate(self.names) if not special[i] and not model.is_byte(i)}
        if any(MARK in n.lstrip(MARK) for n in self.ids):
            raise ValueError("a piece has a mark behind another character, so words are not independent")
        if len(self.bytes_at) != 256:
            raise ValueError("the vocabulary has no piece for each byte")
        scores = np.array([model.get_score(i) for i in range(self.size)])
        order = np.unique(-scores, return_inverse=True)[1]
        self.rank = order.astype(np.int32)  # better scores first
        self.decoded = [b"" if special[i] else n.replace(MARK, " ").encode() for i, n in enumerate(self.names)]
        for b, i in self.bytes_at.items():
            self.decoded[i] = bytes([b])

    @cached_property
    def characters(self) -> np.ndarray:
        """Symbol of each code point; one without a piece is ``size`` + code point and never merges."""
        table = np.arange(0x110000, dtype=np.int32) + self.size
        for name, i in self.ids.items():
            if len(name) == 1 and name != MARK:
                table[ord(name)] = i
        table[ord(" ")] = self.ids[MARK]
        return table

    @cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash table of (left, right) to their piece: keys and pieces, open addressing."""
        pairs = {}
        for name, i in self.ids.items():
            for cut in range(1, len(name)):
                left, right = self.ids.get(name[:cut]), self.ids.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        bits = max(4, (2 * len(pairs)).bit_length())
        keys, values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        left, at = np.array(list(pairs), np.int64), _slot(np.array(list(pairs), np.int64), bits)
        piece = np.array(list(pairs.values()), np.int64)
        while len(left):
            free = keys[at] < 0
            first = np.zeros(len(at), bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            keys[at[put]], values[at[put]] = left[put], piece[put]
            left, piece, at = left[~put], piece[~put], (at[~put] + 1) & ((1 << bits) - 1)
        return keys, values

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece of each pair of symbols, -1 if there is none."""
        keys, values = self.merges
        wanted = left.astype(np.int64) << 32 | right
        at = _slot(wanted, len(keys).bit_length() - 1)
        out = np.full(len(wanted), -1, np.int64)
        open_ = np.arange(len(wanted))
        while len(open_):
            found = keys[at]
            hit = found == wanted[open_]
            out[open_[hit]] = values[at[hit]]
            go = ~hit & (found >= 0)
            open_, at = open_[go], (at[go] + 1) & (len(keys) - 1)
        return out


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys.astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)


_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, rate: float) -> np.ndarray:
    """Whether the candidate that joins [start, middle) and [middle, end) of a unit is skipped under its key."""
    return _drop(key.astype(np.uint64) + _weight(start, middle, end), rate)


def _drop(keyed: np.ndarray, rate: float) -> np.ndarray:
    return (mixed(keyed) >> np.uint64(11)).astype(np.float64) < rate * 2.0**53


def _weight(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return start.astype(np.uint64) * _A + middle.astype(np.uint64) * _B + end.astype(np.uint64) * _C


def _packed(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Places in a unit that is not long as one number."""
    return start.astype(np.int64) << 14 | middle.astype(np.int64) << 7 | end.astype(np.int64)


def agenda(vocabulary: Vocabulary, symbols: list[int], key: int, rate: float) -> list[int]:
    """One unit by a priority queue, in time that grows little faster than its length."""
    n = len(symbols)
    symbol, end = list(symbols), list(range(1, n + 1))
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    queue: list[tuple[int, int, int, int, int]] = []

    def offer(pairs: list[tuple[int, int]]) -> None:
        pairs = [(a, b) for a, b in pairs if a >= 0 and b >= 0]
        if not pairs:
            return
        left, right = (np.array(x) for x in zip(*pairs))
        pieces = vocabulary.merged(np.array([symbol[a] for a, _ in pairs]), np.array([symbol[b] for _, b in pairs]))
        ends = np.array([end[b] for _, b in pairs])
        skip = skipped(np.full(len(pairs), key, np.uint64), left, right, ends, rate) if rate else np.zeros(len(pairs), bool)
        for (a, b), piece, e, s in zip(pairs, pieces.tolist(), ends.tolist(), skip.tolist()):
            if piece >= 0 and not s:
                heapq.heappush(queue, (int(vocabulary.rank[piece]), a, b, e, piece))

    offer([(i, i + 1) for i in range(n - 1)])
    gone = [False] * n
    while queue:
        _, a, b, e, piece = heapq.heappop(queue)
        if gone[a] or gone[b] or after[a] != b or end[b] != e:
            continue
        symbol[a], end[a], gone[b] = piece, e, True
        after[a] = after[b]
        if after[a] >= 0:
            before[after[a]] = a
        offer([(before[a], a), (a, after[a])])
    out, at = [], 0 if n else -1
    while at >= 0:
        out.append(symbol[at])
        at = after[at]
    return out


def merge_rows(vocabulary: Vocabulary, symbols: np.ndarray, size: int, skip: Skip | None, log: Log) -> tuple[np.ndarray, np.ndarray]:
    """The agenda for many units of up to ``size`` symbols at once (a row each, -1 behind them): the symbols left, and
    how many.

    Each round merges the best candidate of every row that has one, and looks again at its two neighbours. ``log`` takes
    (row, start, middle, end) of the merges made, a row's in their order."""
    rows = len(symbols)
    out, counts = np.empty((rows, size), np.int32), np.empty(rows, np.int64)
    row = np.arange(rows)
    symbols = np.concatenate([symbols, np.full((rows, 1), -1)], 1).astype(np.int32)
    start = np.broadcast_to(np.minimum(np.arange(size + 2), size), (rows, size + 2)).astype(np.int32)
    columns = np.arange(size + 2)

    def costs(at: np.ndarray, column: np.ndarray) -> np.ndarray:
        left, right = symbols[at, column], symbols[at, column + 1]
        piece = vocabulary.merged(left, right)
        good = np.flatnonzero(piece >= 0)
        if skip and len(good):
            a, c = at[good], column[good]
            good = good[~skip(row[a], start[a, c], start[a, c + 1], start[a, c + 2])]
        found = np.full(len(at), NO_MERGE, np.int32)
        found[good] = vocabulary.rank[piece[good]]
        return found

    every = np.repeat(np.arange(rows), size)
    cost = costs(every, np.tile(np.arange(size), rows)).reshape(rows, size)
    left = np.count_nonzero(symbols >= 0, axis=1)
    while True:
        j = cost.argmin(1)  # the leftmost of the best
        live = cost[np.arange(len(j)), j] < NO_MERGE
        if not live.all():
            over = ~live
            out[row[over]], counts[row[over]] = symbols[over, :size], left[over]
            if not live.any():
                return out, counts
            symbols, start, cost, row, left, j = (x[live] for x in (symbols, start, cost, row, left, j))
        n = np.arange(len(j))
        log.append((row, start[n, j], start[n, j + 1], start[n, j + 2]))
        piece = vocabulary.merged(symbols[n, j], symbols[n, j + 1])
        symbols[:, :-1] = np.where(columns[:size] > j[:, None], symbols[:, 1:], symbols[:, :-1])
        start[:, :-1] = np.where(columns[: size + 1] > j[:, None], start[:, 1:], start[:, :-1])
        cost[:, :-1] = np.where(columns[: size - 1] > j[:, None], cost[:, 1:], cost[:, :-1])
        symbols[n, j] = piece
        left -= 1
        cost[n, j] = costs(n, j)
        inner = np.flatnonzero(j > 0)
        cost[inner, j[inner] - 1] = costs(inner, j[inner] - 1)


def merge_units(
    vocabulary: Vocabulary, symbols: np.ndarray, sizes: np.ndarray, keys: np.ndarray, rate: float, skip: Skip | None = None, log: Log | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols after all merges, end to end, and how many each unit has; units of like sizes go together.

    Candidates are skipped by ``keys`` and ``rate``, or as ``skip`` says; then no unit may be a long one."""
    counts = np.zeros(len(sizes), np.int64)
    places = np.cumsum(sizes) - sizes
    if skip is None and rate:
        skip = lambda unit, *place: skipped(keys[unit], *place, rate)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    long = sizes > LONG_UNIT
    widths = np.where(long, sizes, WIDTHS[np.minimum(np.searchsorted(WIDTHS, sizes), len(WIDTHS) - 1)])
    for size in np.unique(widths).tolist():
        units = np.flatnonzero(widths == size)
        for at in range(0, len(units), ROWS_AT_ONCE):
            part = units[at : at + ROWS_AT_ONCE]
            if size > LONG_UNIT:
                long_units = [agenda(vocabulary, symbols[a : a + size].tolist(), int(k), rate) for a, k in zip(places[part].tolist(), keys[part])]
                counts[part] = [len(x) for x in long_units]
                done.append((part, np.concatenate(long_units).astype(np.int32)))
                continue
            of_part = skip and (lambda row, *place, part=part: skip(part[row], *place))
            made: Log = []
            table = symbols[np.minimum(places[part][:, None] + np.arange(size), len(symbols) - 1)]
            table = np.where(np.arange(size) < sizes[part][:, None], table, -1)
            rows, counts[part] = merge_rows(vocabulary, table, size, of_part, made)
            done.append((part, rows[np.arange(size) < counts[part][:, None]]))
            if log is not None:
                log += [(part[row], *place) for row, *place in made]
    flat = np.empty(counts.sum(), np.int32)
    begins = np.cumsum(counts) - counts
    for part, left in done:
        n = counts[part]
        flat[np.arange(len(left)) + np.repeat(begins[part] - (np.cumsum(n) - n), n)] = left
    return flat, counts


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places of stretches that begin at ``first``, one after the other."""
    ends = np.cumsum(count)
    return np.arange(int(count.sum())) + np.repeat(first - (ends - count), count)


class PieceEncoder:
    """Texts to ids with dropout ``rate`` under ``seed``.

    Each occurrence of a unit (a word with the spaces before it) has its own key from seed, document and place, and
    each candidate merge of it is skipped or not by that key. Only the merges that a cut really makes can change it, so
    a cut is kept with its merges: an occurrence that skips none of them has this cut, and one that skips some goes on
    to the cut that leaves out the first of them. Cuts are computed once; the draws are made for every occurrence.
    Occurrences that skip in more than ``STEPS`` cuts, that need a cut for the first and only time, or whose unit is
    long are merged on their own, with the same result."""

    def __init__(self, path: str, rate: float = 0.1, seed: int = 1, cache: int = 1_000_000):
        self.vocabulary = Vocabulary(path)
        self.rate, self.seed, self.limit = rate, seed, cache
        self.byte_ids = np.array([self.vocabulary.bytes_at[b] for b in range(256)])
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}  # of units
        self.names: list[str] = []
        self.whole = np.zeros(0, np.int32)  # by unit: the cut that leaves out nothing, -1 if there is none
        self.ids = np.zeros(0, np.uint32)
        # by cut: unit, the merge it leaves out besides those its parent does (-1: none), its ids, its merges
        self.unit, self.without = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.begin, self.made = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # by merge: its cut, its place in the unit (packed, and as it enters the draw), the cut that leaves it out too
        self.owner, self.span = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.weight, self.child = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def _points(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")
        return self.vocabulary.characters[points], np.array([len(u) for u in units], np.int64)

    def _spelled(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the pieces of their UTF-8 bytes."""
        size = self.vocabulary.size
        strange = np.flatnonzero(symbols >= size)
        if len(strange):
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in (symbols[strange] - size).tolist()]
            width = np.ones(len(symbols), np.int64)
            width[strange] = [len(s) for s in spelled]
            counts = np.bincount(np.repeat(np.arange(len(counts)), counts), width, len(counts)).astype(np.int64)
            mask = np.zeros(len(symbols), bool)
            mask[strange] = True
            symbols, mask = np.repeat(symbols, width), np.repeat(mask, width)
            symbols[mask] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return symbols.astype(np.uint32), counts

    def _add_cuts(self, unit: np.ndarray, without: np.ndarray) -> np.ndarray:
        """Numbers of new cuts of units, each without one merge of another cut and all that this one leaves out."""
        symbols, sizes = self._points([self.names[u] for u in unit.tolist()])
        row, at, left_out = np.arange(len(unit)), without, []
        while (some := at >= 0).any():
            row, at = row[some], at[some]
            left_out.append(row << 21 | self.span[at])
            at = self.without[self.owner[at]]
        barred = np.sort(np.concatenate(left_out)) if left_out else None

        def skip(row: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
            wanted = row << 21 | _packed(start, middle, end)
            return barred[np.minimum(np.searchsorted(barred, wanted), len(barred) - 1)] == wanted

        log: Log = []
        no_keys = np.zeros(len(unit), np.uint64)
        ids, counts = self._spelled(*merge_units(self.vocabulary, symbols, sizes, no_keys, 0.0, None if barred is None else skip, log))
        row, start, middle, end = (np.concatenate(x) for x in zip(*log)) if log else [np.zeros(0, np.int64)] * 4
        order = np.argsort(row, kind="stable")
        row, start, middle, end = (x[order] for x in (row, start, middle, end))
        made = np.bincount(row, minlength=len(unit))
        cuts = np.arange(len(self.unit), len(self.unit) + len(unit))
        self.first = np.r_[self.first, len(self.ids) + np.cumsum(counts) - counts]
        self.begin = np.r_[self.begin, len(self.owner) + np.cumsum(made) - made]
        self.count, self.made = np.r_[self.count, counts], np.r_[self.made, made]
        self.ids = np.r_[self.ids, ids]
        self.unit, self.without = np.r_[self.unit, unit.astype(np.int32)], np.r_[self.without, without]
        self.owner = np.r_[self.owner, cuts[row].astype(np.int32)]
        self.span = np.r_[self.span, _packed(start, middle, end).astype(np.int32)]
        self.weight = np.r_[self.weight, _weight(start, middle, end)]
        self.child = np.r_[self.child, np.full(len(row), NEVER, np.int32)]
        return cuts

    def _drawn(self, unit: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cut of each occurrence under its key, and which occurrences are to be merged on their own."""
        at = self.whole[unit].astype(np.int64)
        alone = [np.flatnonzero(at < 0)]
        open_ = np.flatnonzero(at >= 0) if self.rate else np.zeros(0, np.int64)
        for step in range(STEPS + 1):
            n = self.made[at[open_]]
            merges = _spread(self.begin[at[open_]], n)
            of = np.repeat(np.arange(len(open_)), n)
            hit = np.flatnonzero(_drop(np.repeat(keys[open_], n) + self.weight[merges], self.rate))
            hit = hit[np.r_[True, np.diff(of[hit]) > 0][: len(hit)]]  # the first of each occurrence
            open_, merges = open_[of[hit]], merges[hit]
            if not len(open_) or step == STEPS:
                break
            new, times = np.unique(merges[self.child[merges] < 0], return_counts=True)
            once = (times == 1) & (self.child[new] == NEVER)
            self.child[new[once]] = ONCE
            new = new[~once]
            if len(new):
                cuts = self._add_cuts(self.unit[self.owner[new]], new)
                self.child[new] = cuts
            at[open_] = self.child[merges]
            none = at[open_] < 0
            alone.append(open_[none])
            open_ = open_[~none]
        return at, np.concatenate([*alone, open_])

    def encode(self, texts: list[str], documents: list[int]) -> list[bytes]:
        """Ids of each text (little-endian, 32-bit); ``documents`` are numbers that tell texts apart."""
        if len(self.first) > self.limit or len(self.names) > self.limit:
            self._forget()
        cut = [UNIT.findall(" " + t) if t else [] for t in texts]
        sizes = np.array([len(c) for c in cut], np.int64)
        numbers = self.numbers
        fresh = list(dict.fromkeys(u for units in cut for u in units if u not in numbers))
        known = len(numbers)
        numbers.update(zip(fresh, range(known, known + len(fresh))))
        self.names += fresh
        self.whole = np.r_[self.whole, np.full(len(fresh), -1, np.int32)]
        unit = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        times = np.bincount(unit, minlength=len(numbers))
        new = np.flatnonzero((self.whole < 0) & (times > (np.arange(len(numbers)) >= known)))
        new = new[[len(self.names[u]) <= LONG_UNIT for u in new.tolist()]] if len(new) else new
        if len(new):
            self.whole[new] = self._add_cuts(new, np.full(len(new), -1))
        place = np.arange(len(unit)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        own = mixed(np.array([d & 2**64 - 1 for d in documents], np.uint64) ^ mixed(np.array([self.seed & 2**64 - 1], np.uint64)))
        keys = mixed(np.repeat(own, sizes) + place.astype(np.uint64) * _C)
        at, alone = self._drawn(unit, keys)
        symbols, lengths = self._points([self.names[u] for u in unit[alone].tolist()])
        ids, counts = self._spelled(*merge_units(self.vocabulary, symbols, lengths, keys[alone], self.rate))
        # those merged on their own come behind the cuts
        at[alone] = len(self.first) + np.arange(len(alone))
        first = np.r_[self.first, len(self.ids) + np.cumsum(counts) - counts][at]
        n = np.r_[self.count, counts][at]
        flat = np.r_[self.ids, ids][_spread(first, n)].astype("<u4").tobytes()
        edges = (4 * np.r_[0, np.cumsum(n)])[np.r_[0, np.cumsum(sizes)]].tolist()
        return [flat[a:b] for a, b in zip(edges, edges[1:])]

    def decode(self, ids: bytes) -> str:
        found = np.frombuffer(ids, "<u4").tolist()
        text = b"".join(map(self.vocabulary.decoded.__getitem__, found)).decode("utf-8", "surrogatepass")
        return text[1:]  # the space put before the text


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _blocks(texts: list[str], documents: list[int | None], size: int = 1 << 21):
    """Stretches of texts of about ``size`` characters, with numbers for their documents."""
    begin = 0
    while begin < len(texts):
        end, read = begin, 0
        while end < len(texts) and read < size:
            read += len(texts[end])
            end += 1
        yield texts[begin:end], [-1 if d is None else d for d in documents[begin:end]]
        begin = end


def encode_documents(docs: DataFrame, path: str | None = None, rate: float = 0.1, seed: int = 1) -> DataFrame:
    """(doc_id, ids): little-endian 32-bit ids of each row's whole text, one pass without a shuffle.

    What a document draws depends on seed and doc_id only (a row without id draws as if it were -1), so rows repeated
    as a whole are encoded alike. A NULL or empty text has no ids."""

    def encode(batches: Batches) -> Batches:
        encoder = PieceEncoder(path or default_vocabulary(), rate, seed)
        for batch in batches:
            blocks = _blocks(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist())
            out = [ids for texts, documents in blocks for ids in encoder.encode(texts, documents)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "ids"])

    return map_batches(whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id")), encode, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the texts back from their ids, whatever seed and rate they were encoded with."""

    def decode(batches: Batches) -> Batches:
        encoder = PieceEncoder(path or default_vocabulary(), 0.0)
        for batch in batches:
            texts = [encoder.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    return map_batches(encoded, decode, "doc_id long, ids binary, text string")


def round_trips(docs: DataFrame, path: str | None = None, rate: float = 0.1, seed: int = 1) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded_sha256): what :func:`encode_documents` gives and what it decodes to, in one
    pass that keeps neither. ``decoded_sha256`` is that of the text itself (NULL: of the empty text)."""

    def digest(batches: Batches) -> Batches:
        encoder = PieceEncoder(path or default_vocabulary(), rate, seed)
        for batch in batches:
            rows = []
            for texts, documents in _blocks(batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()):
                for ids in encoder.encode(texts, documents):
                    back = encoder.decode(ids).encode("utf-8", "surrogatepass")
                    rows.append((len(ids) // 4, zlib.crc32(ids), hashlib.sha256(back).hexdigest()))
            columns = list(zip(*rows)) or [()] * 3
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256"]
            )

    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string"
    return map_batches(whole_texts(docs, F.col("doc_id").cast("long").alias("doc_id")), digest, schema)
