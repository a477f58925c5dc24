"""Registered queries of the text operators and their reference SQL.

Each query applies its operator to a whole table, of documents for most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    exact_dedup, mixing, ngram_join, packing, pseudonyms, quality, repeated_spans, spelling, token_counts, token_file, toxicity, turn_trie, warc,
)
from .common import documents
from .sql import SQL  # noqa: F401


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Stands for the secret that a caller brings.
PSEUDONYM_KEY = "registered query"


def op1_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonyms.pseudonyms(documents(spark, folder), PSEUDONYM_KEY)


def op2_token_file(spark: SparkSession, folder: str) -> DataFrame:
    return token_file.token_file(documents(spark, folder), tokenizer("byte_bpe_50k.json"), end_id=0)


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder)).drop("bucket", "chain")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), tokenizer("word_bpe_49k.json"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder), tokenizer("word_bpe_49k.json"), end_id=2)


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).drop("source")


def op8_repeated_spans(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans.repeated_spans(documents(spark, folder))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, folder))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.toxicity(documents(spark, folder), labels)


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder))


def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(spark.read.parquet(f"{folder}/pages.parquet"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.conversation_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # at the top of the repository; it imports this module

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii_pseudonyms, op2_token_file, op3_exact_dedup, op4_quality_rules, op5_token_counts, op6_packing,
        op7_source_mix, op8_repeated_spans, op9_jaccard_join, op10_toxicity, op11_spelling_variants, op12_warc,
        op13_conversation_trie, pipeline,
    )
}
