"""From raw documents to packed token sequences, one operator of ``tamiz.llm`` a stage.

Each stage works on all that the one before kept. It is written as Parquet in the shared folder and read
again, so a lost executor costs at most the stage that runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamiz.llm import lines, packing, pii, quality, simhash
from tamiz.session import materialise


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.7 go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line of the corpus matches go; a document may be left without text, but stays."""
    return lines.drop_repeated_lines(docs).drop("n_lines", "n_removed")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked through fingerprints at most four bits apart, the smallest doc_id stays."""
    return simhash.keep_one(docs, words_a_shingle=4, distance=4)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.mask_personal_data(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(packing.cut(docs)).drop("group")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: No SQL for boosted tables, a trained tagger or packing; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
