"""From raw documents to a token file: five stages over the operators of ``kinmaster.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. ``run`` writes each stage's rows as Parquet to the
shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinmaster.llm import decontaminate, huffman, language, mixing, near_dup
from kinmaster.session import materialise


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one of smallest id."""
    return near_dup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold much of a test item, and without such passages in others."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A token file of the mix, as read back: each document's start, length and checksum."""
    return huffman.encoded(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_file", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Compression classes, minima of hashes and token ids have no SQL; tests compare with direct computation.
ORACLE_SQL = None
