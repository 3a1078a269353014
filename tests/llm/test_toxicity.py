import itertools
import random

import pytest
from pyspark.sql import functions as F

from tamiz.llm import toxicity


def brute_segments(scores):
    """Maximal segments by their definition: best segment, then the same left and right of it."""
    best = None
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        s = sum(scores[a:b])
        if s > 0 and (best is None or s > best[2] + 1e-9 or abs(s - best[2]) < 1e-9 and b - a < best[1] - best[0]):
            best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    return brute_segments(scores[:a]) + [best] + [(x + b, y + b, z) for x, y, z in brute_segments(scores[b:])]


def test_segments_against_definition():
    rng = random.Random(2)
    for _ in range(300):
        scores = [rng.choice([-3.1, -1.3, -0.7, 0.9, 1.7, 2.3]) + rng.random() / 100 for _ in range(rng.randrange(1, 14))]
        got, want = toxicity.maximal_segments(scores), brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want], scores


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(800):
        words = [rng.choice(plain) for _ in range(rng.randrange(10, 80))]
        if i % 8 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "Foul", "NASTY"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 8 == 0)))
    # many copies of one toxic text: its harmless words are no evidence
    copy = "vile " + " ".join(f"copy{i}" for i in range(30))
    rows += [(1000 + i, copy) for i in range(60)]
    labels += [(1000 + i, 1, 1) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model(labelled):
    return toxicity.fit_toxicity(*labelled)


def test_learns_telling_words_only(model):
    assert {"vile", "foul", "nasty"} == {w for w, v in model.scores.items() if v > 2}
    # words of the copies are seen in one place each, however often
    assert all(model.scores.get(f"copy{i}", 0) < model.cost for i in range(30))
    assert any(v < 0 for v in model.scores.values())


def test_rare_words_and_clean_evidence(spark):
    """Words seen in half a dozen toxic texts make passages; so many clean words around one outweigh it."""
    rng = random.Random(5)
    plain, rare = [f"word{i}" for i in range(400)], [f"slur{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(3000):
        text = [rng.choice(plain) for _ in range(rng.randrange(20, 60))]
        toxic = i % 15 == 0
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = rng.sample(rare, 4)
        elif i % 3 == 0:
            text += ["gentle", "kindly", rng.choice(plain), "gentle"]
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert sum(model.scores.get(w, 0) > model.cost for w in rare) >= 30 and model.scores["gentle"] < 0
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    wrong = scored.where((F.col("score") >= 0.5) != (F.col("toxic") == 1)).count()
    assert scored.where("toxic = 1").count() > 25 and wrong <= 0.02 * scored.count()
    alone, among = (model.segments(t) for t in (["slur1", "slur2"], ["slur1", *["gentle", "kindly"] * 6, "slur2"]))
    assert len(alone) == 1 and len(among) == 2


def test_ties_and_segments_of_tokens():
    model = toxicity.ToxicModel({"a": 1.5, "b": 1.5, "c": -2.0, "d": 0.2}, cost=0.5)
    text = "x a x b c a d a x"
    tokens = text.split()
    plain = brute_segments([model.scores.get(t, 0) - 0.5 for t in tokens])
    assert [(a, b) for a, b, _ in model.segments(tokens)] == [(a, b) for a, b, _ in plain]
    assert [round(v, 6) for *_, v in model.segments(tokens)] == [round(v, 6) for *_, v in plain]
    rng = random.Random(8)
    free = toxicity.ToxicModel({"a": 1.5171, "b": 1.3913, "c": -2.0377, "d": 0.2}, cost=0.4711)
    for _ in range(200):
        words = [rng.choice("abcdx") for _ in range(rng.randrange(0, 14))]
        want = brute_segments([free.scores.get(t, 0) - free.cost for t in words])
        assert [(a, b) for a, b, _ in free.segments(words)] == [(a, b) for a, b, _ in want], words
    # equal passages are equally significant, wherever they stand
    twice = " ".join(["a a a", *["x"] * 60, "a a a"])
    assert len({round(v, 6) for *_, v in model.segments(twice.split())}) == 1


def test_held_out(labelled, model):
    docs, labels = labelled
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert scored.count() > 100
    assert scored.where((F.col("score") >= 0.5) != (F.col("toxic") == 1)).count() == 0


def test_passages_are_spans(model):
    text = "good " * 40 + "vile foul nasty" + " good" * 40
    _, passages = model.read(text)
    assert [text[a:b] for a, b, _ in passages] == ["vile foul nasty"]
    assert model.read("good " * 40)[1] == []


def test_awkward_rows(documents, empty, model, labelled):
    assert toxicity.score_toxicity(empty, model).count() == 0
    scored = toxicity.score_toxicity(documents.withColumn("passages", F.lit(1)), model)
    assert scored.count() == documents.count()
    assert scored.where("score >= 0.5 or n_passages > 0 or passages != ''").count() == 0
    for labels in (labelled[1].limit(0), labelled[1].where("toxic = 1")):
        flat = toxicity.fit_toxicity(labelled[0], labels)
        assert len({r["score"] for r in toxicity.score_toxicity(documents, flat).collect()}) == 1
    assert toxicity.fit_toxicity(empty, labelled[1]).scores == {}
