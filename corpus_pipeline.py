"""Corpus pipeline: from ``documents`` to the token ids of a clean, deduplicated, balanced mix.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it
keeps, with the columns of ``documents``; the last one adds the ids.  A
stage's result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.llm import bpe, exact_dedup, mixing, ngram_join, quality
from sweepframe.llm.common import fresh, table, written
from sweepframe.llm.queries import vocabulary
from sweepframe.session import prepare

#: Near copies: five-word shingles, similarity of 0.8 or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the training rows of ``labels``, does not reject."""
    return quality.keep_good(prepare(spark), docs, table(spark, sf_dir, "labels"))


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one of the smallest id."""
    return exact_dedup.deduplicate(prepare(spark), docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.deduplicate(prepare(spark), docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight; a document stands as often as the mix takes it."""
    return mixing.mix(prepare(spark), docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, and digests of the ids and of the text decoded from them."""
    ids, decoded, n = fresh(docs, "ids"), fresh(docs, "decoded"), fresh(docs, "n_tokens")
    out = bpe.encode(prepare(spark), docs, vocabulary("word_bpe_49k.json"), ids, decoded)
    return out.select(*[out[f"`{c}`"] for c in docs.columns], ids, F.size(ids).cast("long").alias(n),
                      bpe.ids_digest(F.col(ids)).alias(fresh(docs, "ids_sha256")),
                      bpe.text_digest(F.col(decoded)).alias(fresh(docs, "decoded_sha256")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_deduplication),
    ("ngram_jaccard_join", near_deduplication),
    ("mixing", mixing_sources),
    ("bpe", bpe_encoding),
]

#: Trained trees, similarity joins and merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
