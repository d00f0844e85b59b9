"""The registered queries: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort.llm import (dialogue_sql, hosts, licenses, mixing, near_dup, packing, quality, quality_model, repeats, secrets, sql,
                           token_files, turn_repair, turn_trie, vptree)
from hexcohort.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.judged(read(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, wrapped=True).drop("text")


def op3_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


def op4_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end=0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return hosts.judged(pages).select("page_id", "host", "path", "rule", "verdict", "bad_low")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read(spark, sf_dir, "embeddings"))


def op10_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.without_repeats(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired(turn_repair.damaged(read(spark, sf_dir, "conversations")))


def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality_model.scored(docs, quality_model.fit(docs, read(spark, sf_dir, "labels")))


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.nodes(turn_trie.rebuilt(turn_trie.sequences(read(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_quality_ledger, op2_license_scan, op3_poisson_mixture, op4_cost_packing, op5_secret_scan, op6_token_files,
    op7_host_reputation, op8_near_duplicates, op9_vantage_points, op10_repeated_windows,
    op11_turn_repair, op12_quality_model, op13_turn_trie)}
SQL: dict[str, str] = sql.SQL | {"op11_turn_repair": dialogue_sql.OP11, "op13_turn_trie": dialogue_sql.OP13}
