"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linkloom.llm import (
    hard_negatives,
    hnsw_dedup,
    language_id,
    main_text,
    mixing,
    ngram_join,
    packing,
    pii,
    quality_cnn,
    quality_rules,
    sharding,
    spelling,
    tokens,
)
from linkloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, with_text=False).select(
        "doc_id", "source", "language", "topic", "n_tokens", "probability", "weight"
    )


def op3_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_cnn.score(docs, quality_cnn.learn(docs, table(spark, sf_dir, "labels")))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op6_hnsw_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_dedup.join(table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(
        docs, tokens.path_of("byte_bpe_50k.json"), ranks=tokens.path_of("byte_bpe_50k.tiktoken")
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, tokens.path_of("word_bpe_49k.json"), "word_bpe")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_mixing": op2_mixing,
    "op3_quality_cnn": op3_quality_cnn,
    "op4_sharding": op4_sharding,
    "op5_ngram_join": op5_ngram_join,
    "op6_hnsw_dedup": op6_hnsw_dedup,
    "op7_pii": op7_pii,
    "op8_packing": op8_packing,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_language_id": op11_language_id,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}
SQL: dict[str, str] = {
    "op2_mixing": mixing.sql(),
    "op10_quality_rules": quality_rules.sql(),
    "op12_hard_negatives": hard_negatives.sql(),
}
