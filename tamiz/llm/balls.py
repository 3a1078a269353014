"""Vector code compression: product codes whose codebooks are learnt by ball k-means.

Vectors are cut into parts; each part position has a codebook, and a part's code is its nearest entry. An
entry and the parts assigned to it are a ball. From the second round on, a part is compared only with
entries that can win it: its ball's radius leaves neighbours, the stable core of a ball stays without any
comparison, and the rings around the core say how many neighbours a part has to see. All of it is exact integer
arithmetic, so the result is that of comparing every part with every entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, map_batches, runs
from tamiz.session import materialise, scratch_path
from tamiz.sources.tables import remove

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Bytes of 64-bit numbers that a worker holds as one block of vectors.
BLOCK_BYTES = 8 << 20
#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53
STATE = "kind int, vec_id long, label {label}, vector binary, codes binary, near binary, error long, part int, entry int, n long, far long, sums array<long>"


def component_limit(dimension: int) -> int:
    """Components are held within this bound on both sides, so that no sum of squares of ``dimension``
    differences leaves 60 bits: 2^26 for 64 components, which is 65,536 before scaling."""
    return isqrt((1 << 60) // max(1, dimension)) // 2


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all ``centres``."""
    reach = max(int(np.abs(x).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * reach * reach * max(1, x.shape[1]) < EXACT:
        x, centres = x.astype(np.float64), centres.astype(np.float64)
    cross = x @ centres.T
    return ((x * x).sum(1)[:, None] - 2 * cross + (centres * centres).sum(1)[None, :]).astype(np.int64)


@dataclass
class Codebook:
    """Entries of one part position, and what the round before says about their balls.

    ``far`` is the squared radius each ball had around its old entry; ``old`` are those entries. Both are absent
    in the first round, in which every part is compared with all entries."""

    centres: np.ndarray
    old: np.ndarray | None = None
    far: np.ndarray | None = None

    def __post_init__(self):
        if self.old is None:
            return
        between = _squares(self.centres, self.centres)
        self.order = np.argsort(between, axis=1, kind="stable")
        # an entry is its own first neighbour, unless another has the same place
        self.apart = np.take_along_axis(between, self.order, 1)
        shift = np.sqrt(((self.centres - self.old).astype(np.float64) ** 2).sum(1))
        # a bound of the radius around the new entry, rounded up by more than double precision can lose
        reach = 4 * ((np.sqrt(self.far.astype(np.float64)) + shift) * (1 + 1e-9) + 1e-6) ** 2
        self.neighbours = (self.apart <= reach[:, None]).sum(1)
        moved = shift > 0
        seen = np.arange(between.shape[1])[None, :] < self.neighbours[:, None]
        #: Nothing changed in the ball or next to it, so all of its parts stay as they are.
        self.still = ~moved & ~(moved[self.order] & seen).any(1)

    def assign(self, x: np.ndarray, code: np.ndarray | None, near: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row of ``x``, the lowest of equals, and its squared distance."""
        if self.old is None:
            found = _squares(x, self.centres)
            code = found.argmin(1)
            return code, found[np.arange(len(x)), code]
        code, near = code.copy(), near.copy()
        active = np.flatnonzero(~self.still[code])
        if not len(active):
            return code, near
        offset = x[active] - self.centres[code[active]]
        near[active] = (offset * offset).sum(1)
        # another entry can be as near only from half the way to it, and stable cores end before the nearest one
        second = self.apart[:, 1] if self.apart.shape[1] > 1 else np.full(len(self.centres), np.iinfo(np.int64).max)
        ring = active[4 * near[active] >= second[code[active]]]
        ring = ring[np.argsort(code[ring], kind="stable")]
        starts, lengths = runs(code[ring])
        for start, length in zip(starts.tolist(), lengths.tolist()):
            self._rings(x, ring[start : start + length], code, near)
        return code, near

    def _rings(self, x: np.ndarray, rows: np.ndarray, code: np.ndarray, near: np.ndarray) -> None:
        """Parts of one ball outside its core. A part sees the neighbours up to twice its own distance, which is
        a prefix of the neighbours by distance; rings with up to twice as many are compared together."""
        ball = code[rows[0]]
        apart, order = self.apart[ball, : self.neighbours[ball]], self.order[ball]
        seen = np.searchsorted(apart, 4 * near[rows], side="right")
        width = np.ceil(np.log2(np.maximum(seen, 1))).astype(int)
        for w in np.unique(width):
            inside = rows[width == w]
            candidates = np.unique(np.r_[order[: seen[width == w].max()], ball])
            found = _squares(x[inside], self.centres[candidates])
            best = found.argmin(1)
            code[inside] = candidates[best]
            near[inside] = found[np.arange(len(inside)), best]


def _blocks(batches: Batches, rows: int) -> Iterator[pa.Table]:
    waiting, held = [], 0
    for batch in batches:
        waiting.append(batch)
        held += batch.num_rows
        if held >= rows:
            yield pa.Table.from_batches(waiting)
            waiting, held = [], 0
    if held:
        yield pa.Table.from_batches(waiting)


def _numbers(column: pa.ChunkedArray, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _packed(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as the bytes of its numbers."""
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    offsets = (np.arange(len(rows) + 1, dtype=np.int64) * size).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _scaled(column: pa.Array, dimension: int, padded: int) -> np.ndarray:
    """Integer components of whole vectors, with zeros behind them up to a multiple of the parts."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dimension)
    limit = component_limit(dimension)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(values * SCALE), -limit, limit).astype(np.int64)
    return np.pad(whole, ((0, 0), (0, padded - dimension)))


def _round(rows: DataFrame, books: list[Codebook], width: int, label: str) -> DataFrame:
    """Assign all parts once. Rows leave with their state (kind 0); each task adds, for every entry it met, the
    number, sums and greatest squared distance of its parts (kind 1)."""
    parts, entries = len(books), len(books[0].centres)
    schema = STATE.format(label=label)
    block = max(256, BLOCK_BYTES // (8 * max(1, parts * width)))

    def assign(batches: Batches) -> Batches:
        n = np.zeros((parts, entries), np.int64)
        far = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64)
        types = None
        for table in _blocks(batches, block):
            types = table.schema.field("label").type
            x = _numbers(table.column("vector"), "<i4", parts * width).astype(np.int64)
            first = books[0].old is None
            codes = None if first else _numbers(table.column("codes"), "u1", parts).astype(np.int64)
            near = None if first else _numbers(table.column("near"), "<i8", parts)
            code, distance = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), np.int64)
            for p, book in enumerate(books):
                part = x[:, p * width : (p + 1) * width]
                code[:, p], distance[:, p] = book.assign(part, None if first else codes[:, p], None if first else near[:, p])
                n[p] += np.bincount(code[:, p], minlength=entries)
                np.maximum.at(far[p], code[:, p], distance[:, p])
                by_entry = np.argsort(code[:, p], kind="stable")
                starts, _ = runs(code[by_entry, p])
                if len(starts) and width:
                    sums[p][code[by_entry[starts], p]] += np.add.reduceat(part[by_entry], starts, axis=0)
            none = len(x)
            columns = [
                pa.array(np.zeros(none, np.int32)), *(table.column(c).combine_chunks() for c in ("vec_id", "label", "vector")),
                _packed(code.astype("u1")), _packed(distance.astype("<i8")), pa.array(distance.sum(1)), *(pa.nulls(none, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])
        if types is None:
            return
        part, entry = np.nonzero(n)
        met = len(part)
        columns = [
            pa.array(np.ones(met, np.int32)), *(pa.nulls(met, t) for t in (pa.int64(), types, pa.binary(), pa.binary(), pa.binary(), pa.int64())),
            pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]), pa.array(far[part, entry]),
            pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in schema.split(", ")])

    return map_batches(rows.select("vec_id", "label", "vector", *([] if books[0].old is None else ["codes", "near"])), assign, schema)


def _updated(state: DataFrame, books: list[Codebook]) -> list[Codebook]:
    """Codebooks after a round. What reaches the driver is as long as the codebooks are."""
    partial = state.where("kind = 1")
    balls = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.max("far").alias("far")).collect()
    each = partial.select("part", "entry", F.posexplode("sums").alias("at", "value"))
    sums = each.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total")).collect()
    centres, far = [b.centres.copy() for b in books], [np.zeros(len(b.centres), np.int64) for b in books]
    count = {}
    for r in balls:
        count[r["part"], r["entry"]] = r["n"]
        far[r["part"]][r["entry"]] = r["far"]
    for r in sums:
        centres[r["part"]][r["entry"], r["at"]] = int(r["total"]) // count[r["part"], r["entry"]]
    return [Codebook(c, b.centres, f) for c, b, f in zip(centres, books, far)]


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, column: str = "embedding"
) -> DataFrame:
    """(vec_id, label, codes, error, books_sha256) of each whole vector: one byte for each of ``parts``.

    Components become ``floor(1024 x)``. Codebooks start with the parts of the vectors with the ``entries`` smallest
    ids (equal ids by their components, NULL ids last) and are replaced ``rounds`` times by the floored means of
    their balls; an entry without parts stays. ``error`` is the squared distance to the entries, summed over parts.

    Vectors that are NULL or hold NULL or non-finite components are dropped. Fewer vectors than ``entries`` make
    shorter codebooks, repeated rows are coded one by one, ties go to the lower entry, and no vectors
    give no rows. A length that is no multiple of ``parts`` is filled up with zeros. Vectors of another length than
    that of the smallest id cannot be compared: they stay, with NULL codes and error. Components beyond
    :func:`component_limit` count as that limit, so that all distances are exact in 64 bits.

    The driver and each worker hold the codebooks, which is all that does not grow with the table; each round
    reads and writes the vectors once, in the shared folder, and deletes the round before."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte")
    spark = vectors.sparkSession
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.col(column).isNotNull() & finite).select("vec_id", "label", F.col(column).cast("array<double>").alias("components"))
    smallest = kept.orderBy(F.col("vec_id").asc_nulls_last(), "components").limit(entries).select("components").collect()
    label = kept.schema["label"].dataType.simpleString()
    if not smallest:
        return spark.createDataFrame([], f"vec_id long, label {label}, codes binary, error long, books_sha256 string")
    dimension = len(smallest[0][0])
    width = -(-dimension // parts)
    same = [r[0] for r in smallest if len(r[0]) == dimension]
    start = _scaled(pa.array(same, pa.list_(pa.float64())), dimension, parts * width)
    books = [Codebook(start[:, p * width : (p + 1) * width]) for p in range(parts)]

    def scale(batches: Batches) -> Batches:
        for batch in batches:
            whole = _packed(_scaled(batch.column("components"), dimension, parts * width).astype("<i4"))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), whole], names=["vec_id", "label", "vector"])

    fitting = F.size("components") == dimension
    rows = map_batches(kept.where(fitting), scale, f"vec_id long, label {label}, vector binary")
    written = None
    for turn in range(rounds + 1):
        path = scratch_path(spark, f"codes-{turn}")
        _round(rows, books, width, label).write.parquet(path)
        if written:
            remove(spark, written)
        state, written = spark.read.schema(STATE.format(label=label)).parquet(path), path
        rows = state.where("kind = 0")
        if turn < rounds:
            books = _updated(state, books)
    text = ",".join(str(v) for b in books for v in b.centres.ravel().tolist())
    digest = F.lit(hashlib.sha256(text.encode()).hexdigest())
    coded = rows.select("vec_id", "label", "codes", "error", digest.alias("books_sha256"))
    unfit = kept.where(~fitting).select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error"), digest.alias("books_sha256"))
    return coded.unionByName(unfit)


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the error summed over all rows of the same label, NULL labels together.

    Sums are combined in every task before they meet, and the table of labels is written, so that it is broadcast
    only if it is small; beyond that a hot label's side of the join is split. A sum beyond 64 bits stays at the greatest long."""
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy("label").agg(F.when(total > most, most).otherwise(total).cast("long").alias("label_error"))
    totals = materialise(totals.withColumnRenamed("label", "_label"), "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
