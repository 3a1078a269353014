"""Embedding near-duplicates through spherical-cap filters.

Filter directions are a product code: each of a few blocks of (rotated) coordinates has its own random
unit vectors, and a direction takes one from each. A vector is decoded block by block to all directions
whose cap it lies in; vectors that share a direction meet. A sixteen-bit copy with a proven error bound settles
almost every pair on the spot, and the rest is compared in double precision. A pair counts where it meets first,
so that links are summed up by the task that finds them and no list of pairs is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.llm.common import Batches, components, map_batches, runs, whole_runs
from tamiz.session import materialise

SHORT_RUN = 32
BLOCK = 1024
PAIRS_AT_ONCE = 1 << 16
#: Beyond what rounding in double precision can add to a dot product of unit vectors.
SLACK = 1e-9


def cap_height(dimension: int, share: float) -> float:
    """Height above which a random unit vector lies with the given probability."""
    s = np.linspace(-1, 1, 400_001)
    weight = (1 - s * s) ** ((max(dimension, 3) - 3) / 2)
    above = np.cumsum(weight[::-1])
    return float(s[::-1][np.searchsorted(above / above[-1], share)])


class CapFilters:
    """Directions for one dimension: ``codes`` unit vectors in each of ``blocks`` blocks after a rotation.

    ``lists`` is the expected number of caps around a vector. That number varies, as directions share their
    blocks; a vector with fewer than ``least`` has its height lowered step by step until it has them."""

    def __init__(self, dimension: int, rows: int, lists: float, least: int, number: int = 0, occupancy: float = 2.0, blocks: int = 3, seed: int = 11):
        rng = np.random.default_rng([seed, dimension, number])
        self.blocks = min(blocks, dimension)
        wanted = max(64.0, rows * lists / occupancy)
        self.codes = int(np.ceil(wanted ** (1 / self.blocks)))
        self.rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
        self.cuts = [round(i * dimension / self.blocks) for i in range(self.blocks + 1)]
        books = (rng.standard_normal((b - a, self.codes)) for a, b in zip(self.cuts, self.cuts[1:]))
        self.books = [book / np.linalg.norm(book, axis=0) for book in books]
        self.height = cap_height(dimension, min(0.5, lists / self.codes**self.blocks))
        self.least = min(least, self.codes**self.blocks)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of all directions whose product with the row reaches the row's height."""
        turned = unit @ self.rotation
        scores = [turned[:, a:b] @ book for (a, b), book in zip(zip(self.cuts, self.cuts[1:]), self.books)]
        height = np.full(len(unit), self.height)
        while True:
            row, direction = self._reaching(scores, height * np.sqrt(self.blocks))
            poor = np.bincount(row, minlength=len(unit)) < self.least
            if not poor.any():
                return row, direction
            height[poor] = np.where(height[poor] > 0.02, height[poor] * 0.93, height[poor] - 0.05)

    def _reaching(self, scores: list[np.ndarray], need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tops = [s.max(1) for s in scores]
        row, direction = np.arange(len(need)), np.zeros(len(need), np.int64)
        total = np.zeros(len(need))
        for j, score in enumerate(scores):
            rest = sum(tops[j + 1 :], np.zeros(len(need)))
            reached = total[:, None] + score[row]
            at, code = np.nonzero(reached >= (need - rest)[row][:, None])
            total = reached[at, code]
            row, direction = row[at], direction[at] * self.codes + code
        return row, direction


def unit_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of the arrays, and the usable ones (no NULL, no non-finite component, not zero) as unit vectors."""
    lengths, units = [], []
    for v in column.to_pylist():
        x = np.array(v if v and None not in v else [], dtype=np.float64)
        scale = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
        x = x / scale if scale else x
        lengths.append(len(x) if scale else 0)
        units.append(x / np.linalg.norm(x) if scale else x)
    return np.array(lengths), units


def _small_copies(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sixteen-bit coordinates, their step, and a bound on the length of what they leave out."""
    step = np.abs(unit).max(1) / 32767
    small = np.rint(unit / step[:, None]).astype(np.int16)
    left = np.linalg.norm(unit - small * step[:, None], axis=1) + SLACK
    return small, step, left


def _decode(rows: int, codes: int, lists: float, least: int):
    def decode(batches: Batches) -> Batches:
        filters: dict[int, list[CapFilters]] = {}
        for batch in batches:
            ids, size = batch.column("cid").to_numpy(), batch.column("size").to_numpy()
            lengths, units = unit_vectors(batch.column("embedding"))
            for dimension in np.unique(lengths[lengths > 0]).tolist():
                if dimension not in filters:
                    filters[dimension] = [CapFilters(dimension, rows, lists, least, k) for k in range(codes)]
                where = np.flatnonzero(lengths == dimension)
                for at in range(0, len(where), 256):
                    part = where[at : at + 256]
                    unit = np.stack([units[i] for i in part])
                    small, step, left = _small_copies(unit)
                    copies = [small[i].tobytes() for i in range(len(part))]
                    met = [code.decode(unit) for code in filters[dimension]]
                    row = np.concatenate([r for r, _ in met])
                    name = np.concatenate([(d << 16) ^ ((dimension & 0xFFF) << 4) ^ k for k, (_, d) in enumerate(met)])
                    order = np.lexsort((name, row))
                    row, name = row[order], name[order]
                    starts, _ = runs(row)
                    first = starts[np.searchsorted(starts, np.arange(len(row)), "right") - 1]
                    early = [name[f:n].tobytes() for n, f in enumerate(first.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(name), pa.array(ids[part][row]), pa.array(size[part][row]), pa.array([copies[i] for i in row], pa.binary()),
                            pa.array(step[row]), pa.array(left[row]), pa.array(early, pa.binary()),
                        ],
                        ["filter", "cid", "size", "small", "step", "left", "early"],
                    )

    return decode


def _early_table(column: pa.ChunkedArray) -> np.ndarray:
    """One row of filter numbers per vector, smallest first, then -1; filters that only one of the vectors has are left out."""
    lists = column.to_pylist()
    lengths = np.array([len(e) // 8 for e in lists], np.int64)
    _, code, often = np.unique(np.frombuffer(b"".join(lists), np.int64), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(lists)), lengths)[often[code] > 1]
    code = code[often[code] > 1]
    starts, lengths = runs(row)
    place = np.arange(len(row)) - np.repeat(starts, lengths)
    early = np.full((len(lists), int(lengths.max()) if len(lengths) else 0), -1, np.int32)
    early[row, place] = code
    return early


def _meet_first(early: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the vectors of a pair share none of the filters before the one they meet in."""
    first = np.ones(len(i), bool)
    for at in range(0, len(i), PAIRS_AT_ONCE):
        waiting = np.arange(at, min(at + PAIRS_AT_ONCE, len(i)))
        for place in range(early.shape[1]):
            name = early[i[waiting], place]
            waiting, name = waiting[name >= 0], name[name >= 0]
            if not len(waiting):
                break
            shared = (early[j[waiting]] == name[:, None]).any(1)
            first[waiting[shared]] = False
            waiting = waiting[~shared]
    return first


def _hang(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the trees of linked rows; ``root`` names the smallest row of each row's tree, before and after."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def _compare(threshold: float):
    """What the pairs that meet first in a cell come to: (a, NULL, near) how many rows a node links with, (a, b, 0) a tree
    over linked nodes, and (a, b, NULL) the pairs that the small copies leave open."""

    def compare(batches: Batches) -> Batches:
        for table in whole_runs(batches):
            cell = table.column("cell").to_numpy()
            starts, lengths = runs(cell)
            keep = np.repeat(lengths > 1, lengths)
            if not keep.any():
                continue
            table = table.filter(pa.array(keep))
            cell = cell[keep]
            ids, size, side, name = (table.column(c).to_numpy() for c in ("cid", "size", "side", "filter"))
            step, left = table.column("step").to_numpy(), table.column("left").to_numpy()
            copies = table.column("small").to_pylist()
            wide = np.array([len(c) // 2 for c in copies])
            x = np.zeros((len(copies), int(wide.max())))
            x[np.arange(x.shape[1]) < wide[:, None]] = np.frombuffer(b"".join(copies), np.int16)
            early = _early_table(table.column("early"))
            root, near_rows, open_pairs = np.arange(len(ids)), np.zeros(len(ids), np.int64), []

            def judge(near, i, j):
                # both small copies are at most 1 + left long
                doubt = left[i] * (1 + left[j]) + left[j] * (1 + left[i]) + left[i] * left[j] + SLACK
                good = (near + doubt >= threshold) & (ids[i] != ids[j]) & (name[i] == name[j]) & (wide[i] == wide[j])
                good &= (side[i] < 0) | (side[i] != side[j])
                i, j, sure = i[good], j[good], (near - doubt >= threshold)[good]
                first = _meet_first(early, i, j)
                open_pairs.append((ids[i[first & ~sure]], ids[j[first & ~sure]]))
                i, j = i[first & sure], j[first & sure]
                np.add.at(near_rows, i, size[j])
                np.add.at(near_rows, j, size[i])
                _hang(root, i, j)

            starts, lengths = runs(cell)
            short = np.flatnonzero(np.repeat(lengths <= SHORT_RUN, lengths))
            for shift in range(1, SHORT_RUN):
                if len(short) <= shift:
                    break
                i, j = short[shift:], short[:-shift]
                met = cell[i] == cell[j]
                if not met.any():
                    break
                i, j = i[met], j[met]
                judge(np.einsum("ij,ij->i", x[i], x[j]) * step[i] * step[j], i, j)
            for start, length in zip(starts[lengths > SHORT_RUN].tolist(), lengths[lengths > SHORT_RUN].tolist()):
                for a in range(start, start + length, BLOCK):
                    for b in range(a, start + length, BLOCK):
                        p, q = np.arange(a, min(a + BLOCK, start + length)), np.arange(b, min(b + BLOCK, start + length))
                        near = (x[p] @ x[q].T) * step[p][:, None] * step[q]
                        i, j = np.nonzero(near >= threshold - 0.25)
                        i, j, near = p[i], q[j], near[i, j]
                        once = i > j if a == b else np.ones(len(i), bool)
                        judge(near[once], i[once], j[once])
            linked, hung = np.flatnonzero(near_rows), np.flatnonzero(root != np.arange(len(root)))
            a, b = (np.concatenate(c) for c in zip(*open_pairs)) if open_pairs else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[linked], ids[hung], a])),
                    pa.array(np.concatenate([ids[linked], ids[root[hung]], b]), mask=np.arange(len(linked) + len(hung) + len(a)) < len(linked)),
                    pa.array(
                        np.concatenate([near_rows[linked], np.zeros(len(hung) + len(a), np.int64)]),
                        mask=np.arange(len(linked) + len(hung) + len(a)) >= len(linked) + len(hung),
                    ),
                ],
                ["a", "b", "near"],
            )

    return compare


def _exact(threshold: float):
    def exact(batches: Batches) -> Batches:
        for batch in batches:
            ends = (unit_vectors(batch.column(c))[1] for c in ("x", "y"))
            good = [len(x) == len(y) and float(x @ y) >= threshold for x, y in zip(*ends)]
            yield batch.select(["a", "b", "of_a", "of_b"]).filter(pa.array(good, pa.bool_()))

    return exact


def link_vectors(
    classes: DataFrame, threshold: float = 0.95, codes: int = 3, lists: float = 8.0, least: int = 6, cell_rows: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """Of nodes ``cid`` that stand for ``size`` rows with one ``embedding``: (cid, near), the rows of other nodes whose cosine
    reaches the threshold and that share a filter, and (a, b), links that join the same nodes as all of them.

    A filter with more than ``cell_rows`` vectors is dealt into parts that meet pairwise, so no task gets
    them all. Each of ``codes`` product codes puts a vector into ``lists`` caps on average and ``least`` at least; the
    number of directions grows with the rows, so that the vectors a cap meets by chance do not. A vector takes the names of its
    earlier filters along, by which a pair knows whether it has met before; only pairs within the error of the
    sixteen-bit copies are written, for the comparison of their vectors."""
    spark = classes.sparkSession
    rows = classes.count()
    postings = materialise(
        map_batches(
            classes.select("cid", "size", "embedding"), _decode(rows, codes, lists, least),
            "filter long, cid long, size long, small binary, step double, left double, early binary",
        ),
        "cap-postings",
    )
    hot = postings.groupBy("filter").count().where(F.col("count") > cell_rows)
    # written first, so that its size is known: as a rule it is short, and the postings need not be shuffled to meet it
    hot = materialise(hot.select("filter", F.ceil(F.col("count") / cell_rows).cast("int").alias("parts")), "hot-caps")
    part = F.pmod(F.xxhash64("cid", F.lit(3)), F.col("parts")).cast("int")
    dealt = postings.join(hot, "filter", "left").withColumn("part", part)
    others = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = dealt.withColumn("other", F.explode(others))
    cell = F.xxhash64("filter", F.least("part", "other"), F.greatest("part", "other"))
    # the side tells the two parts of a cell apart; within one part, or an undivided filter, all pairs count
    side = F.when((F.col("other") < 0) | (F.col("part") == F.col("other")), F.lit(-1)).otherwise(F.col("part"))
    cells = dealt.select(cell.alias("cell"), "filter", "cid", "size", "small", "step", "left", "early", side.cast("int").alias("side"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = map_batches(cells.repartition(parts, "cell").sortWithinPartitions("cell"), _compare(threshold), "a long, b long, near long")
    met = materialise(met, "cap-links")
    ends = classes.select("cid", "size", "embedding")
    open_pairs = (
        met.where("near IS NULL").select("a", "b")
        .join(ends.toDF("a", "of_a", "x"), "a")
        .join(ends.toDF("b", "of_b", "y"), "b")
        .select("a", "b", "of_a", "of_b", "x", "y")
    )
    settled = materialise(map_batches(open_pairs, _exact(threshold), "a long, b long, of_a long, of_b long"), "cap-links")
    counts = (
        met.where("b IS NULL").select("a", "near")
        .unionByName(settled.select("a", F.col("of_b").alias("near")))
        .unionByName(settled.select(F.col("b").alias("a"), F.col("of_a").alias("near")))
    )
    counts = counts.groupBy(F.col("a").alias("cid")).agg(F.sum("near").alias("near"))
    return counts, met.where("b IS NOT NULL AND near = 0").select("a", "b").unionByName(settled.select("a", "b"))


def near_vectors(table: DataFrame, threshold: float = 0.95, **caps) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``table`` (vec_id, embedding).

    Rows with the same components are one node however many they are, and linked with each other. Vectors
    that are NULL, empty, zero or hold a NULL or non-finite component, and rows without vec_id, link with nothing: no links,
    their own component. Vectors of different lengths never link. Rows that share a vec_id are rows of their own."""
    usable = (
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    named = rows.where("usable").withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit(1), F.reverse("embedding"))})
    classes = named.groupBy("k1", "k2").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"), F.first("embedding").alias("embedding"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "vectors")
    counts, links = link_vectors(classes, threshold, **caps)
    reached = components(links).withColumnsRenamed({"node": "cid"})
    placed = classes.select("cid", "k1", "k2", "least", "size").join(counts, "cid", "left").join(reached, "cid", "left")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "cid")), "vectors-placed")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    told = placed.join(names, "component").select("k1", "k2", (F.col("size") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), "component_id")
    linked = named.select("vec_id", "k1", "k2").join(told, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
