import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tamiz.llm import pii, quality, simhash
from tamiz.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, FOLDER).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    for name in ("quality", "line_dedup", "near_dedup", "personal_data"):
        assert stages[name].columns == stages["documents"].columns


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept, marked = by_id(stages["quality"]), by_id(labels)
    assert all((i in kept) == bool(r["quality"]) for i, r in marked.items() if r["quality"] is not None)
    assert all(r == by_id(stages["documents"])[i] for i, r in kept.items())


def test_line_stage(stages):
    before, after = by_id(stages["quality"]), by_id(stages["line_dedup"])
    assert before.keys() == after.keys()
    earlier = []
    for i in sorted(before):
        kept = []
        for line in before[i]["text"].split("\n"):
            words = frozenset(line.encode().lower().split())
            if not words or not any(5 * len(words & e) >= 4 * len(words | e) for e in earlier):
                kept.append(line)
            if words:
                earlier.append(words)
        assert after[i]["text"] == "\n".join(kept) and after[i]["n_chars"] == len(after[i]["text"])


def test_near_duplicate_stage(stages):
    before, after = by_id(stages["line_dedup"]), by_id(stages["near_dedup"])
    bits = {i: simhash.fingerprint(r["text"].encode(), 4) for i, r in before.items()}
    reach = {i: {j for j in bits if (bits[i] ^ bits[j]).bit_count() <= 4} for i in bits}
    while (wider := {i: set().union(*(reach[j] for j in r)) for i, r in reach.items()}) != reach:
        reach = wider
    assert after == {i: before[i] for i in before if i == min(reach[i])}


def test_personal_data_stage(stages):
    before, after = by_id(stages["near_dedup"]), by_id(stages["personal_data"])
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not pii.base_spans(before[i]["text"]) or "[" in r["text"]
        if not pii.TELLTALE.search(before[i]["text"]):
            assert r == before[i]
    assert not any(pii.base_spans(r["text"]) for r in after.values())


def test_packing_stage(stages):
    packed = stages["packing"]
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(by_id(stages["personal_data"]))
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("want"))
    assert whole.where("n != want").count() == 0


def test_run_as_the_stages(spark, stages):
    columns = ("doc_id", "start", "length", "ids_crc32", "sequence_id", "offset")
    got = corpus_pipeline.run(spark, FOLDER).select(*columns).collect()
    assert sorted(got) == sorted(stages["packing"].select(*columns).collect())


def test_empty_stages(spark, empty, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_awkward_documents(spark, documents, tmp_path):
    labels = [(i, 1, 0) for i in range(0, 50, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents.withColumns({"n_lines": F.lit(1), "score": F.lit("x"), "spans": F.lit("y")})
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.mode("overwrite").parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_tables(spark, name):
    done = QUERIES[name](spark, FOLDER)
    table = {"op4": "pages", "op8": "embeddings", "op11": "embeddings"}.get(name.split("_")[0], "documents")
    key = {"pages": "page_id", "embeddings": "vec_id", "documents": "doc_id"}[table]
    want = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    assert done.select(key).distinct().count() == want.count()
    if not name.startswith("op7"):
        assert done.count() == want.count()


def test_sql_of_queries(spark):
    import oracle
    from tamiz.llm.queries import ORACLES

    con = oracle.connect(FOLDER)
    for name, sql in ORACLES.items():
        assert oracle.difference(QUERIES[name](spark, FOLDER), con, sql) is None


def test_quality_features_of_empty():
    assert quality.features("") == quality.features(" \n") == [0.0] * len(quality.FEATURES)
