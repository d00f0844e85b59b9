"""From raw documents to packed sequences: five stages, each one of the text operators.

Each stage works on what the one before kept, written as Parquet and read again; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort.llm import mixing, near_dup, packing, quality, secrets
from hexcohort.sources.scratch import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the production policy go."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id stays."""
    return near_dup.distinct_documents(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the secrets in it are replaced."""
    return secrets.redact(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as the target weights of their sources ask."""
    return mixing.mixed(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens in sequences of 1024, one row per piece."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0)


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("secret scans", secret_scans),
          ("source mixture", source_mixture), ("packing", sequences)]

#: The last stage counts a tokenizer's ids and the second one hashes shingles, which SQL cannot; tests hold all stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
