import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamiz.llm import caps
from tamiz.llm.common import Forest


def clusters(seed, n=40, dimension=24, spread=0.05):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        centre = rng.standard_normal(dimension)
        for _ in range(int(rng.choice([1, 2, 12]))):
            v = centre * rng.uniform(0.1, 9) + rng.standard_normal(dimension) * spread * np.linalg.norm(centre) / np.sqrt(dimension) * rng.uniform(0, 12)
            rows.append(v.astype(np.float32).tolist())
    return rows


def awkward(vectors):
    rows = [(10 + i, v) for i, v in enumerate(vectors)]
    rows += [(1, rows[0][1]), (2, rows[0][1]), (rows[3][0], rows[5][1]), rows[4]]  # copies, an id used twice, a row repeated
    rows += [(3, None), (4, []), (5, [0.0] * 24), (6, [float("nan")] + [1.0] * 23), (7, [None] + [1.0] * 23), (8, [float("inf")] * 24)]
    return rows + [(9, [1.0, 2.0]), (1009, [2.0, 4.0]), (None, rows[0][1])]


def expected(rows, threshold):
    units = []
    for i, v in rows:
        ok = i is not None and v and None not in v and np.isfinite(v).all() and any(v)
        units.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links, forest = [0] * len(rows), Forest()
    for a in range(len(rows)):
        for b in range(a):
            if units[a] is not None and units[b] is not None and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                links[b] += 1
                forest.join(a, b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[forest.root(a)] = min(least.get(forest.root(a), i), i)
    return sorted(((i, n, least.get(forest.root(a)), i == least.get(forest.root(a))) for a, ((i, _), n) in enumerate(zip(rows, links))), key=str)


@pytest.mark.parametrize("cell_rows", [20_000, 5])
def test_against_all_pairs(spark, cell_rows):
    rows = awkward(clusters(1))
    found = caps.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), cell_rows=cell_rows)
    assert sorted((tuple(r) for r in found.collect()), key=str) == [
        (i, n, c, True if i is None else k) for i, n, c, k in expected(rows, 0.95)
    ]


@pytest.mark.parametrize("cell_rows", [20_000, 40])
def test_large_group_around_the_threshold(spark, cell_rows):
    """Pairs that meet in many filters, in short and long runs and in parts of hot filters, count once."""
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(24)
    group = [(i, (centre + rng.standard_normal(24) * 0.15 * (1 + i % 3)).tolist()) for i in range(300)]
    x = np.array([v for _, v in group])
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = (x @ x.T >= 0.95).sum(1) - 1
    found = caps.near_vectors(spark.createDataFrame(group, "vec_id long, embedding array<double>"), cell_rows=cell_rows, lists=40.0, least=30)
    links = np.array([r["n_links"] for r in found.orderBy("vec_id").collect()])
    assert (links <= true).all() and links.sum() >= 0.98 * true.sum() > 10_000


def test_pairs_meet_first_once():
    rng = np.random.default_rng(5)
    lists = [np.sort(rng.choice(60, rng.integers(0, 9), replace=False)) for _ in range(80)]
    early = caps._early_table(pa.chunked_array([pa.array([v.astype(np.int64).tobytes() for v in lists], pa.binary())]))
    i, j = np.nonzero(np.tri(80, k=-1))
    assert caps._meet_first(early, i, j).tolist() == [not set(lists[a]) & set(lists[b]) for a, b in zip(i, j)]


def test_trees_of_linked_rows():
    rng = np.random.default_rng(6)
    i, j = rng.integers(0, 300, (2, 220))
    root, forest = np.arange(300), Forest()
    for at in range(0, 220, 50):
        caps._hang(root, i[at : at + 50], j[at : at + 50])
    for a, b in zip(i.tolist(), j.tolist()):
        forest.join(a, b)
    assert root.tolist() == [forest.root(a) for a in range(300)]


def test_lengths_that_share_a_filter_do_not_link():
    """Filters are named by the length's last twelve bits."""
    x = np.zeros((2, 4098))
    x[:, :2] = 0.6, 0.8
    small, step, left = caps._small_copies(x)
    copies = [small[0].tobytes(), small[1, :2].tobytes()]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 7]), pa.array([7, 7]), pa.array([1, 2]), pa.array([1, 1]), pa.array(copies, pa.binary()), pa.array(step), pa.array(left),
         pa.array([b"", b""], pa.binary()), pa.array([-1, -1], pa.int32())],
        ["cell", "filter", "cid", "size", "small", "step", "left", "early", "side"],
    )
    assert sum(out.num_rows for out in caps._compare(0.95)(iter([batch]))) == 0


def test_small_copies_bound_the_product():
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((200, 40))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    small, step, left = caps._small_copies(unit)
    near = (small * step[:, None]) @ (small * step[:, None]).T
    doubt = left[:, None] * (1 + left) + left * (1 + left[:, None]) + left[:, None] * left
    assert (np.abs(unit @ unit.T - near) <= doubt).all()


def test_decoding_lists_all_directions():
    rng = np.random.default_rng(3)
    code = caps.CapFilters(9, 200, lists=12.0, least=1)
    unit = rng.standard_normal((20, 9))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    row, direction = code.decode(unit)
    turned = unit @ code.rotation
    blocks = [turned[:, a:b] @ book for a, b, book in zip(code.cuts, code.cuts[1:], code.books)]
    scores = (blocks[0][:, :, None, None] + blocks[1][:, None, :, None] + blocks[2][:, None, None, :]).reshape(20, -1)
    for i in range(20):
        got = set(direction[row == i].tolist())
        best = np.sort(scores[i])[-len(got)]
        assert got == set(np.flatnonzero(scores[i] >= best - 1e-12).tolist())
        assert len(got) >= 1 and set(np.flatnonzero(scores[i] >= code.height * np.sqrt(3)).tolist()) <= got


def test_recall_on_driver_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.select("vec_id", "embedding").collect()]
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    true = int((x @ x.T >= 0.8).sum()) - len(x)
    found = caps.near_vectors(table, threshold=0.8).agg(F.sum("n_links")).first()[0]
    assert found <= true and found >= 0.9 * true


def test_empty_table(spark):
    assert caps.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, cid int, size int")).count() == 0
