import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tamiz.llm import lines


def expected(rows):
    """Texts after removal, by comparing each line with all earlier ones."""
    xx = {t: h for t, h in {(r["text"] or ""): r["row"] for r in rows}.items()}
    order = {}
    for r in rows:
        text = r["text"] or ""
        key = (r["doc_id"] if r["doc_id"] is not None else lines.LAST_ID, xx[text])
        order[key] = text
    earlier, removed = [], {}
    for key in sorted(order):
        gone = set()
        for i, line in enumerate(order[key].encode().split(b"\n")):
            words = frozenset(line.lower().split())
            if not words:
                continue
            if any(5 * len(words & e) >= 4 * len(words | e) for e in earlier):
                gone.add(i)
            earlier.append(words)
        removed[key] = gone
    out = []
    for r in rows:
        text = r["text"]
        key = (r["doc_id"] if r["doc_id"] is not None else lines.LAST_ID, xx[text or ""])
        gone = removed[key]
        kept = text if not gone else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        out.append((r["doc_id"], kept, len((text or "").split("\n")), len(gone)))
    return sorted(out, key=str)


def check(docs):
    rows = docs.withColumn("row", F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF))).collect()
    got = lines.drop_repeated_lines(docs).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def similar_lines(seed, documents=80, vocabulary=60):
    rng = random.Random(seed)
    lines_ = [" ".join(f"v{int(rng.random() ** 2 * vocabulary)}" for _ in range(rng.choice([1, 3, 4, 5, 9, 12, 30]))) for _ in range(120)]
    rows = []
    for i in range(documents):
        chosen = []
        for _ in range(rng.randrange(1, 8)):
            words = rng.choice(lines_).split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = f"v{rng.randrange(vocabulary)}"
            chosen.append(" ".join(words) if rng.random() < 0.9 else "")
        rows.append((i, "\n".join(chosen)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    check(spark.createDataFrame(similar_lines(seed), "doc_id long, text string").repartition(5))


def test_split_words_and_second_round(spark, monkeypatch):
    """Words dealt into parts, and lines that their nearest partner does not settle."""
    rng = random.Random(5)
    whole = [[f"v{rng.randrange(5000)}" for _ in range(30)] for _ in range(12)]
    rows = []
    for i in range(240):
        words = list(whole[i % 12])
        for k in rng.sample(range(30), rng.choice([1, 2, 3, 3])):
            words[k] = f"v{rng.randrange(5000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    original, prefix, rounds = lines.later_matches, lines._prefix_words, []
    monkeypatch.setattr(lines, "later_matches", lambda d: original(d, split_over=40, most_parts=5))
    monkeypatch.setattr(lines, "_prefix_words", lambda rarity: rounds.append(1) or prefix(rarity))
    check(docs)
    assert rounds


def test_sets_are_read_once_and_stored_for_open_lines_alone(spark, monkeypatch):
    rng = random.Random(7)
    whole = [[f"v{rng.randrange(5000)}" for _ in range(30)] for _ in range(12)]
    rows = [(i, " ".join(f"v{rng.randrange(5000)}" if rng.random() < 0.12 else w for w in whole[i % 12])) for i in range(240)]
    docs = lines.identified(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    seen, stored, made = spark.sparkContext.accumulator(0), [], []
    materialise, sets_of = lines.materialise, lines._sets_of

    def counted(marks):
        find = sets_of(marks)
        made.append(1)

        def counting(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield from find(iter([batch]))

        return counting

    def storing(df, name):
        stored.append((name, materialise(df, name)))
        return stored[-1][1]

    monkeypatch.setattr(lines, "_sets_of", counted)
    monkeypatch.setattr(lines, "materialise", storing)
    lines.later_matches(docs).collect()
    assert len(made) == 2 and seen.value == 2 * len(rows)
    with_words = [(n, df) for n, df in stored if "words" in df.columns]
    assert [n for n, _ in with_words] == ["lines-tried"]
    tried = with_words[0][1]
    sizes = [len(r["words"]) for r in tried.where("words is not null").collect()]
    assert 0 < len(sizes) < tried.count() and min(sizes) > 0


def test_lines_marked_by_chance():
    """A key counts as marked only if all its places are."""
    keys = lines.mixed(np.arange(1000, dtype=np.uint64))
    marks = np.zeros((1 << 15) // 8, np.uint8)
    for shift in lines.SHIFTS:
        place = (keys[:100] << np.uint64(shift) >> np.uint64(49)).astype(np.int64)
        np.bitwise_or.at(marks, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    chosen = lines.well_marked(marks, keys)
    assert chosen[:100].all() and chosen.sum() < 105
    assert not len(lines.well_marked(marks, keys[:0]))


def test_pairs_of_a_cell():
    """All partners where they are asked for, the nearest one else, whatever the cells."""
    rows = similar_lines(6, documents=40, vocabulary=30)
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([0] * len(rows)), pa.array([t for _, t in rows])], ["doc_id", "row", "text"])
    sets = {}
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            if line.split():
                sets[i, k] = frozenset(line.split())
    first = {}
    for at in sorted(sets):
        first.setdefault(sets[at], at)
    reps = sorted(first.values())
    want = {(b, a) for b in reps for a in reps if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    rarity = np.zeros(lines.RARITY_BUCKETS, np.uint8)
    for ways in (1, 4):
        split = np.full(lines.RARITY_BUCKETS, ways, np.int16)
        cells = {}
        for out in lines._emit(rarity, split, 3, None)(iter([batch])):
            for r in out.to_pylist():
                if r["kind"] == 1:
                    cells.setdefault(r["cell"], []).append(r["records"])
        for only in (None, np.full(4096, 255, np.uint8)):
            found = set()
            for cell, blobs in cells.items():
                later, earlier, _ = lines._pairs(np.frombuffer(b"".join(blobs), lines.POSTING), cell, only)
                found |= {((a["doc"], a["line"]), (b["doc"], b["line"])) for a, b in zip(later, earlier)}
            assert found >= want if only is not None else {x for x, _ in found} >= {x for x, _ in want}


def emitted(texts, rarity, words_of):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([0] * len(texts)), pa.array(texts)], ["doc_id", "row", "text"])
    out = lines._emit(rarity, np.ones(lines.RARITY_BUCKETS, np.int16), 3, words_of)(iter([batch]))
    return np.frombuffer(b"".join(r["records"] for b in out for r in b.to_pylist() if r["kind"] == 1), lines.POSTING)


def test_second_round_leaves_out_lines_too_long_to_match():
    """Words of an open line's prefix count only in lines whose size may match it."""
    rarity, words = np.zeros(lines.RARITY_BUCKETS, np.uint8), [f"w{i}" for i in range(400)]
    texts = [" ".join(words[:n]) for n in (40, 31, 32, 50, 51, 300)]
    open_set = np.sort(lines.word_hashes(np.frombuffer(texts[0].encode(), np.uint8), np.array([0]))[1])
    sets = pa.RecordBatch.from_arrays([pa.array([open_set.tobytes()], pa.binary())], ["words"])
    keys = np.concatenate([b.column("key").to_numpy().view(np.uint64) for b in lines._prefix_words(rarity)(iter([sets]))])
    marks = np.zeros(1 << 21, np.uint8)
    np.bitwise_or.at(marks, (keys >> np.uint64(43)).astype(np.int64), np.uint8(1) << (keys >> np.uint64(40) & np.uint64(7)).astype(np.uint8))
    found = emitted(texts, rarity, marks)
    assert {0, 2, 3} <= set(found["doc"].tolist()) <= {0, 1, 2, 3, 4}
    for doc in (0, 2, 3):  # the line itself with its whole prefix, its partners with records as in the first round
        first = emitted(texts, rarity, None)
        both = [set(map(bytes, r[r["doc"] == doc])) for r in (found, first)]
        assert both[0] <= both[1] and (doc or both[0] == both[1])


def test_words_that_meet_no_other_are_left_out():
    texts = ["a b c d e", "a b c d f"]
    rarity = np.full(lines.RARITY_BUCKETS, 40, np.uint8)
    once = lines.word_hashes(np.frombuffer(b"e", np.uint8), np.array([0]))[1]
    rarity[lines.bucket_of(once)] = np.round(8 * np.log2(1 + 1.0))
    found = emitted(texts, rarity, None)
    assert len(found) and (once & np.uint64(0xFFFFFFFF)).item() not in found["token"].tolist()
    alone = np.zeros(5, lines.POSTING)
    alone["token"], alone["size"], alone["doc"] = [5, 5, 2**32 - 1, 2**32 - 1, 7], [10, 13, 10, 12, 10], range(5)
    kept = lines.Postings(alone)
    assert sorted(kept.token.tolist()) == [2**32 - 1] * 2 and len(kept.record_of) == 2
    assert [(i.tolist(), j.tolist()) for i, j, _ in kept.pairs(1 << 16)] == [([0], [1])]
    assert not list(lines.Postings(alone[:0]).pairs(1 << 16))


def test_awkward_rows(documents, empty):
    check(documents.select("doc_id", "text"))
    done = lines.drop_repeated_lines(documents.withColumn("n_lines", F.lit("mine")).withColumn("key", F.lit(1)))
    assert done.columns == [*documents.columns, "key", "n_lines", "n_removed"]
    assert done.count() == documents.count()
    assert done.where("n_chars != length(text)").count() == 0
    assert lines.drop_repeated_lines(empty).count() == 0


def test_hashes_of_words():
    texts = ["Ab ab\tAB  aB", "", "x" * 9 + " " + "x" * 8, "ab", "y" * 17 + "\n" + "y" * 16 + "z"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
    at, hashes = lines.word_hashes(raw, starts)
    assert len(at) == 9 and len(set(hashes.tolist())) == 5
    assert len(set(hashes[:4].tolist())) == 1 and hashes[6] == hashes[0]
    batch = pa.RecordBatch.from_arrays([pa.array([None, "", "a b", "c"][2:])], ["text"])
    assert [(f, bytes(r), s.tolist()) for f, r, s in lines.chunks(batch)] == [(0, b"a bc", [0, 3])]


def test_one_order_of_words():
    """Words whose sort keys are equal come in one order in every line, however the chunk is cut."""
    rng = np.random.default_rng(0)
    original = lines.word_hashes

    def coarse(raw, starts):
        at, hashes = original(raw, starts)
        return at, hashes & np.uint64(0xFFFF)  # the bits that sort before the whole hash are all zero

    lines.word_hashes = coarse
    try:
        orders = set()
        for _ in range(20):
            words = [f"w{i}" for i in rng.permutation(40)] + ["w3", "w5"]
            raw = np.frombuffer(" ".join(words).encode(), np.uint8)
            found = lines.Lines(raw, np.array([0]), np.zeros(lines.RARITY_BUCKETS, np.uint8))
            orders.add(tuple(found.words.tolist()))
        assert len(orders) == 1 and len(next(iter(orders))) == 40
    finally:
        lines.word_hashes = original


def test_bounds():
    for n in range(1, 60):
        for m in range(1, 60):
            need = lines.overlap_needed(n, m)
            reaching = [o for o in range(min(n, m) + 1) if 5 * o >= 4 * (n + m - o)]
            assert (min(reaching) if reaching else min(n, m) + 1) == need or need > min(n, m)
        assert lines.prefix_length(n) == n - min(o for o in range(n + 1) if 5 * o >= 4 * n) + 1
