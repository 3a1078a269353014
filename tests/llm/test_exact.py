import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import common, exact, lines


def expected(rows):
    groups = {}
    for r in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
        groups.setdefault(text, []).append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        out += [(i, least, len(ids), i == least, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.fixture()
def stored(documents, tmp_path):
    path = str(tmp_path / "documents.parquet")
    documents.repartition(3).write.parquet(path)
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_against_plain_grouping(spark, documents, stored):
    assert rows(exact.deduplicate(spark, stored)) == expected(documents.collect())


def test_many_batches(spark, documents, stored):
    assert rows(exact.deduplicate(spark, stored, bytes_a_batch=1)) == expected(documents.collect())


@pytest.mark.parametrize("digest", [lambda text: F.lit("same"), lambda text: (F.length(text) % 3).cast("string")])
def test_bytes_decide_on_equal_digests(spark, documents, stored, digest):
    assert rows(exact.deduplicate(spark, stored, digest=digest)) == expected(documents.collect())


def test_state_goes_on(spark, tmp_path):
    path, folder = str(tmp_path / "in"), "file://" + str(tmp_path / "state")

    def add(*values):
        spark.createDataFrame(list(values), "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema("doc_id long, text string").parquet(path)
        stream = stream.select("doc_id", "text", exact.content_locator().alias("locator"))
        return {r["keep_id"]: (r["seen"], r["locator"]) for r in exact.stream_classes(stream, folder).collect()}

    first = add((5, "a"), (7, "b"))
    assert {k: n for k, (n, _) in first.items()} == {5: 1, 7: 1}
    later = add((9, "a"), (2, "b"), (3, "c"))
    assert {k: n for k, (n, _) in later.items()} == {5: 2, 2: 2, 3: 1}
    assert later[5][1] == first[5][1] and later[2][1] != first[7][1]


def test_empty_table_and_clashing_columns(spark, empty, tmp_path):
    path = str(tmp_path / "empty.parquet")
    empty.write.parquet(path)
    assert exact.deduplicate(spark, path).count() == 0
    path = str(tmp_path / "clash.parquet")
    columns = {c: F.lit("x") for c in ("digest", "locator", "seen", "keep_id", "kept")}
    empty.sparkSession.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string").withColumns(columns).write.parquet(path)
    assert rows(exact.deduplicate(spark, path).select("doc_id", "keep_id", "kept")) == [(1, 1, True), (2, 1, False)]


def test_session_settings_come_back(spark, stored):
    before = {k: spark.conf.get(k, None) for k in exact.STATE_SETTINGS}
    exact.deduplicate(spark, stored)
    assert {k: spark.conf.get(k, None) for k in exact.STATE_SETTINGS} == before


def test_filter_of_keys_loses_none(spark, monkeypatch):
    """Whatever its size; a full one lets everything pass."""
    rows = spark.range(5000).select((F.col("id") * 7919).alias("k"), F.col("id").alias("chunk"))
    wanted = rows.where("chunk % 5 = 0").select("k")
    some = common.only_in(rows, wanted, "k")
    assert some.columns == rows.columns
    kept = {r["chunk"] for r in some.collect()}
    assert kept >= set(range(0, 5000, 5)) and len(kept) < 1400
    assert common.only_in(rows, wanted.limit(0), "k").count() == 0
    monkeypatch.setattr(common, "LEAST_PLACES", 4)
    monkeypatch.setattr(common, "MOST_PLACES", 4)
    assert common.only_in(rows, wanted, "k").count() == 5000


def test_marks_of_keys(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for some in (df, df.limit(1)):
        marks = lines._bits_of(some, "key")
        assert lines.marked(marks, np.array([r["key"] for r in some.collect()]).view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 3000).view(np.uint64)
    assert lines.marked(lines._bits_of(df, "key"), other).mean() < 0.12


def test_full_filters_change_no_result(documents, monkeypatch):
    want = sorted((tuple(r) for r in lines.drop_repeated_lines(documents).collect()), key=str)
    monkeypatch.setattr(common, "LEAST_PLACES", 15)
    monkeypatch.setattr(common, "MOST_PLACES", 15)
    monkeypatch.setattr(common, "PLACES_PER_KEY", 1)
    assert sorted((tuple(r) for r in lines.drop_repeated_lines(documents).collect()), key=str) == want
