"""A corpus from raw documents to packed sequences: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but the last return
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontaminate, packing, privacy, similar, toxicity
from corpusloom.llm.common import materialize, read, small_batches
from corpusloom.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the scores are learned from ``labels``."""
    small_batches(spark)
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of equal or similar documents the one with the smallest ``doc_id`` stays."""
    small_batches(spark)
    return similar.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover an item of ``benchmark`` go."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind; every document stays."""
    small_batches(spark)
    return privacy.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.best_fit_pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("packing", pack),
]

# The models of the stages and their tokenizer have no SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
