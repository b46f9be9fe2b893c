"""Corpus pipeline: quality, near duplicates, repeated substrings, benchmark contamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.llm import bpe, decontaminate, jaccard, quality, suffixes
from registrar.llm.common import ensure_checkpoint_dir, ship_package, table


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking, learnt from the labels, predicts to be good."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates (five-word shingles, Jaccard of 0.8 or more)."""
    ship_package(spark)
    return jaccard.keep_one(docs)


def cut_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that start earlier; texts that lose everything go."""
    ship_package(spark)
    cut = suffixes.dedup(docs).filter((F.col("n_removed") == 0) | (F.col("text") != ""))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))
        cut = cut.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in a benchmark window."""
    ship_package(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with their number and digest, and the digest of the decoded text."""
    ship_package(spark)
    return bpe.round_trip(docs.select("doc_id", "text"), ids=True).drop("text")


STAGES = [
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeated_substrings),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenize),
]

#: A learnt score decides in the first stage, which SQL cannot express; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, by way of Parquet in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
