"""Labelled samples for training: bounded, deterministic, disjoint from the held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on, at most.
SAMPLE = 20_000
#: ``crc32(doc_id as text) mod FOLDS`` of held-out rows.
FOLDS, HELD_OUT = 3, 1


def held_out(doc_id: Column) -> Column:
    """Rows kept from training; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(labels: DataFrame, column: str, rows: int = SAMPLE) -> DataFrame:
    """``doc_id, label`` of at most ``rows`` training rows, the first by a hash of the id.

    Rows without id or label, and held-out ones, are left out; an id with
    several labels counts with the largest.
    """
    doc_id = F.col("doc_id").cast("long")
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out(doc_id))
             .groupBy(doc_id.alias("doc_id")).agg(F.max(F.col(column).cast("int")).alias("label")))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def labelled_texts(docs: DataFrame, labels: DataFrame, column: str, rows: int = SAMPLE) -> DataFrame:
    """``doc_id, text, label`` of the sample's documents, one row per id: at most ``rows`` rows.

    The sample is broadcast; rows that repeat an id are reduced to the
    smallest text where they lie, before the shuffle (null only if all are).
    """
    few = F.broadcast(sample(labels, column, rows))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few, "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
