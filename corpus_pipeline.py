"""From raw documents to packed training sequences.

Each stage gets the rows that its predecessor kept, all of them, and its
decisions take effect: documents that fail the quality rules go, of equal texts
one stays, of near copies (five-word shingles, Jaccard similarity 0.8 or more,
linked transitively) one stays, sources are brought to their target shares, and
what is left is packed. All but the last stage return the columns of documents.
A stage's result is written to the shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pathways.llm import exact_dedup, mixing, ngram_join, packing, quality
from pathways.llm.common import documents, stage
from pathways.llm.queries import tokenizer

NEAR_WORDS = 5
NEAR_PERCENT = 80


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing_rows(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", unlike_documents),
    ("source mix", mixed_documents),
    ("packing", packed_documents),
]

# Tokenizing and the order of the shuffled sources are beyond SQL; tests hold it against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
