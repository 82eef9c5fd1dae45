"""Exact dedup against a persistent digest index (DataFrame operations only).

The index is a Parquet table bucketed and sorted by digest.  A batch is
reduced to one row per digest (partial aggregation first, so a text that
holds a third of all rows costs one row per task), sort-merge anti-joined
with the index without moving the index, and the new digests are appended.

Defined results:

* null text counts as empty; runs of ASCII white space count as one space;
* of equal texts the smallest ``doc_id`` stays (null ids last); rows that
  repeat both id and text count as copies, and one row of them is kept;
* texts already in the index are all dropped and point to the index's id;
* an empty batch gives an empty result and leaves the index as it is;
* other columns pass through ``deduplicate`` unchanged, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.llm.common import SPACE, blank, hot_join, maybe_broadcast, numbered, written
from sweepframe.session import prepare, scratch_path

DIGEST_BUCKETS = 64


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(blank(text), f"{SPACE}+", " ")


def digest(text: str | Column) -> Column:
    """SHA-256 of the normalised text's UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """Digests seen so far: ``digest, keep_id, n``, bucketed and sorted by digest at ``path``.

    Opening an existing path continues it; the bucket count must stay the same.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = DIGEST_BUCKETS):
        prepare(spark)
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_path(spark, "digest_index")
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"""CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, n BIGINT) USING parquet
                      CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'""")

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, new: DataFrame) -> None:
        """Append new digests: one file per bucket, sorted."""
        (new.select("digest", "keep_id", "n").repartition(self.buckets, "digest")
            .write.insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)


def resolve(spark: SparkSession, staged: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per digest of ``staged (rid, doc_id, digest)``: ``digest, keep_id, n_batch, n, keep_rid``
    (``keep_rid`` null where the index has the text already).  The new digests are appended."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "rid"))
    batch = (staged.groupBy("digest").agg(first.alias("f"), F.count(F.lit(1)).alias("n_batch"))
             .select("digest", F.col("f.doc_id").alias("keep_id"), F.col("f.rid").alias("keep_rid"), "n_batch"))
    batch = written(spark, batch, "digest_batch")
    seen = index.read()
    new = (batch.join(seen.hint("merge"), "digest", "left_anti")
           .select("digest", "keep_id", "n_batch", F.col("n_batch").alias("n"), "keep_rid"))
    old = (batch.drop("keep_id", "keep_rid").join(seen.hint("merge"), "digest")
           .select("digest", "keep_id", "n_batch", (F.col("n") + F.col("n_batch")).alias("n"),
                   F.lit(None).cast("long").alias("keep_rid")))
    found = written(spark, new.unionByName(old), "digest_found")
    index.append(found.where("keep_rid IS NOT NULL"))
    return found


def dedup_report(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Every document with the decision on it: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    staged = written(spark, docs.select(F.monotonically_increasing_id().alias("rid"),
                                        F.col("doc_id").cast("long").alias("doc_id"),
                                        digest("text").alias("digest")), "digest_staged")
    found = resolve(spark, staged, index or DigestIndex(spark))
    out = hot_join(staged, found, "digest", "n_batch", staged.count())
    return out.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                      F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(False)).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns.  ``docs`` is read twice, so it should come from files.

    The dropped row ids are broadcast when their count is within
    ``BROADCAST_ROWS``; beyond that the anti-join shuffles.
    """
    full, rid = numbered(spark, docs, "digest_full")
    staged = written(spark, full.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                                        digest("text").alias("digest")), "digest_staged")
    found = resolve(spark, staged, index or DigestIndex(spark))
    keep = found.where("keep_rid IS NOT NULL").select(F.col("keep_rid").alias("rid"))
    dropped = written(spark, staged.select("rid").join(keep, "rid", "left_anti"), "digest_dropped")
    dropped = maybe_broadcast(dropped, dropped.count())
    return full.join(dropped, full[rid] == dropped["rid"], "left_anti").select(*[full[f"`{c}`"] for c in docs.columns])
