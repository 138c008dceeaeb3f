"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sightline.llm import bpe, exact_dedup, language_id, minhash, packing, suffix_dedup
from sightline.llm.common import forget, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; null texts and texts without a letter go."""
    return language_id.with_language(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest doc_id, of each group of equal texts."""
    return exact_dedup.kept_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group of near copies."""
    return minhash.first_of_each_group(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 100 bytes that start earlier in the corpus too."""
    return suffix_dedup.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the packed sequences."""
    return packing.pack(docs, bpe.vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("language id", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("suffix dedup", suffix_stage),
    ("packing", packing_stage),
]

#: The stages learn models and tokenise: SQL can't say them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
