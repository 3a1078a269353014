import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import quality
from tamiz.llm.common import held_out


def sample(n=600, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(["the", "of", "and", "river", "stone", "house"]) for _ in range(rng.randrange(20, 90))]
        good = i % 3 > 0
        if not good:
            kind = i % 2
            words = [w.upper() + "!!" for w in words] if kind else [words[0]] * len(words)
        rows.append((i, " ".join(words), "x", "y", 1))
        labels.append((i, int(good), 0))
    return rows, labels


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([*labels, (5, None, 0), (None, 1, 0), labels[7]], "doc_id long, quality int, toxic int")


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = quality.fit_quality(docs, labels)
    scored = quality.score_quality(docs, model).withColumn("out", held_out(F.col("doc_id"), 4, 2))
    rows = [r for r in scored.collect() if r["out"]]
    assert len(rows) > 50
    assert all((r["score"] >= 0.7) == (r["doc_id"] % 3 > 0) for r in rows)


def test_held_out_labels_are_not_learned(labelled):
    docs, labels = labelled
    wrong = labels.withColumn("quality", F.when(held_out(F.col("doc_id"), 4, 2), 1 - F.col("quality")).otherwise(F.col("quality")))
    x = np.array([quality.features(t) for t in ("the river and the stone", "THE!! RIVER!!")])
    assert (quality.fit_quality(docs, labels).score(x) == quality.fit_quality(docs, wrong).score(x)).all()


def test_pairs_learn_what_single_tables_cannot():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    single = quality.BoostedTables(pairs=0).fit(x, y).score(x)
    both = quality.BoostedTables(pairs=2)
    paired = both.fit(x, y).score(x)
    assert ((single > 0.5) == y).mean() < 0.7 < 0.95 < ((paired > 0.5) == y).mean()
    assert (0, 1) in both.pair_tables


def test_constant_without_evidence(documents, labelled):
    for labels in (labelled[1].limit(0), labelled[1].where("quality = 1")):
        model = quality.fit_quality(labelled[0], labels)
        assert len({r["score"] for r in quality.score_quality(documents, model).collect()}) == 1


def test_awkward_rows(documents, empty, labelled):
    model = quality.fit_quality(*labelled)
    assert quality.score_quality(empty, model).count() == 0
    scored = quality.score_quality(documents.withColumn("score", F.lit("mine")), model)
    assert scored.columns == [*documents.columns, "score"]
    assert scored.where("score between 0 and 1").count() == documents.count()


def test_keep_good_keeps_columns(labelled):
    kept = quality.keep_good(*labelled)
    assert kept.columns == labelled[0].columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in range(600) if i % 3 > 0}
