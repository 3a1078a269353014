"""Queries of the corpus operators over the driver tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm import alignment, balls, caps, exact, lines, packing, pieces, pii, quality, shards, simhash, template, toxicity
from tamiz.llm.common import held_out, whole_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.score_quality(whole_texts(docs, "doc_id"), quality.fit_quality(docs, labels))
    score = F.col("score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), score, (score >= 0.7).cast("int").alias("predicted")
    )


@query
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.deduplicate(spark, f"{folder}/documents.parquet")


ORACLES["op3_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM texts
"""


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score_toxicity(whole_texts(docs, "doc_id"), toxicity.fit_toxicity(docs, labels))
    score = F.col("score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), score, (score >= 0.5).cast("int").alias("predicted"),
        "n_passages", "passages",
    )


@query
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words_a_shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.cut(table(spark, folder, "documents"))).drop("group")


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


@query
def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_vectors(table(spark, folder, "embeddings"), threshold=0.95)


@query
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return template.extract_articles(table(spark, folder, "pages"))


@query
def op2_sentencepiece_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trips(table(spark, folder, "documents"), rate=0.1, seed=1)


@query
def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = whole_texts(table(spark, folder, "documents"), "doc_id")
    return pii.find_personal_data(docs, pii.fit_tagger(docs)).drop("text")


@query
def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.assign(table(spark, folder, "documents"), shards=24)


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = balls.label_errors(balls.compress(table(spark, folder, "embeddings"), parts=4, entries=256, rounds=4))
    code = F.lower(F.hex("codes")).alias("code")
    return coded.select("vec_id", code, "error", "label_error", F.col("books_sha256").alias("codebooks_sha256"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))[0]
