import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import balls

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """Every part against every entry, in Python's integers."""
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1]) // parts
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        found = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return found.index(min(found)), min(found)

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], book)[0], []).append(c[p])
            for k, ms in members.items():
                book[k] = [sum(col) // len(ms) for col in zip(*ms)]
    out, by_label = [], {}
    for (i, _, label), c in zip(kept, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(e for _, e in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, label, bytes(k for k, _ in found).hex(), error))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, code, error, by_label[label], digest) for i, label, code, error in out), key=str)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    coded = balls.label_errors(balls.compress(df, **how))
    return sorted(((r["vec_id"], r["codes"].hex(), r["error"], r["label_error"], r["books_sha256"]) for r in coded.collect()), key=str)


def vectors(n, dimension, seed, spread=0.2):
    """Clusters with copies, so that balls have cores, rings and ties."""
    rng = np.random.default_rng(seed)
    middles = rng.standard_normal((12, dimension))
    rows = (middles[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, dimension))).astype(np.float32)
    rows[n // 2 : n // 2 + n // 6] = rows[0]
    return [(i, [float(x) for x in v], [None, 1, 2, 3][i % 4]) for i, v in enumerate(rows)]


@pytest.mark.parametrize(("entries", "rounds", "spread"), [(16, 4, 0.2), (64, 6, 0.05), (5, 0, 0.2), (1, 4, 0.2)])
def test_against_every_part_with_every_entry(spark, entries, rounds, spread):
    rows = vectors(500, 16, entries, spread)
    assert found(spark, rows, entries=entries, rounds=rounds) == plain(rows, entries=entries, rounds=rounds)


def test_awkward_rows(spark):
    """Coarse values that tie everywhere, repeated rows and ids, no id, and vectors that are dropped."""
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) / 1024 for x in v], None) for i, v in enumerate(rng.integers(-2, 3, (300, 8)))]
    rows += rows[:40] + [(5, [0.0] * 8, 1), (None, [0.5] * 8, 2), (None, [-0.5] * 8, 2)]
    rows += [(900, None, 1), (901, [None] * 8, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] + [0.0] * 7, None)]
    want = plain(rows, entries=20)
    assert found(spark, rows, entries=20) == want and len(want) == 343


def test_assignment_skips_and_rings_change_nothing():
    """Rounds driven without Spark, block by block, with whatever balls the blocks have."""
    rng = np.random.default_rng(2)
    for scale in (3, 60, 4000, 1 << 22):
        x = rng.integers(-scale, scale + 1, (900, 3)) + (rng.integers(0, 5, (900, 1)) * 4 * scale)
        book = balls.Codebook(x[:40].copy())
        code, near = book.assign(x, None, None)
        stayed = 0
        for _ in range(12):
            centres, far = book.centres.copy(), np.zeros(40, np.int64)
            for k in np.unique(code):
                centres[k] = x[code == k].sum(0) // (code == k).sum()
                far[k] = near[code == k].max()
            book = balls.Codebook(centres, book.centres, far)
            pieces = [book.assign(x[a : a + 250], code[a : a + 250], near[a : a + 250]) for a in range(0, 900, 250)]
            code, near = (np.concatenate(c) for c in zip(*pieces))
            every = ((x[:, None, :] - centres[None]) ** 2).sum(2)
            assert (code == every.argmin(1)).all() and (near == every.min(1)).all()
            stayed += int(book.still.sum())
        assert stayed > 0


def test_lengths(spark):
    """No multiple of the parts, empty vectors, far components, and vectors of another length."""
    rows = [(i, [float(i % 7), -1.0, float(i % 3)], 0) for i in range(30)]
    padded = [(i, [*v, 0.0], label) for i, v, label in rows]
    assert found(spark, rows, entries=4) == plain(padded, entries=4)
    assert {r[1:4] for r in found(spark, [(i, [], i) for i in range(3)])} == {("00000000", 0, 0)}
    df = spark.createDataFrame([*rows, (40, [1.0, 2.0], 9), (41, [3e38, -3e38, 1.0], 5)], VECTORS).withColumn("codes", F.lit("clash")).withColumn("kind", F.lit(1))
    got = {r["vec_id"]: r for r in balls.label_errors(balls.compress(df, entries=4)).collect()}
    assert len(got) == 32 and got[40]["codes"] is None and got[40]["error"] is None and got[40]["label_error"] is None
    assert got[41]["codes"] is not None and got[41]["error"] >= 0


def test_empty_table(spark):
    none = spark.createDataFrame([(1, None, 1)], VECTORS)
    assert balls.label_errors(balls.compress(none)).count() == 0
    assert balls.compress(none.limit(0)).count() == 0
