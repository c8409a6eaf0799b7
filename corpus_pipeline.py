"""A training-data pipeline over ``documents``: five stages, each one operator of ``clickcredit.llm``.

``STAGES`` lists them in order. Each takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.

SQL can't express the language models, the alignment or the packing, so
there is no ``ORACLE_SQL``; the tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickcredit.llm import decontaminate, exact_dedup, langid, packing, simhash
from clickcredit.llm.queries import language_model
from clickcredit.llm.shared import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; the rejected ones go."""
    return langid.keep_identified(docs, language_model(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id."""
    return simhash.deduplicate(docs, shingle_words=3, max_bits=3)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_into_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their bins."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("best_fit_packing", pack_into_bins),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
