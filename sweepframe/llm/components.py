"""Connected components of a link table by alternating star contractions.

Each round reattaches every node's larger neighbours to the smallest node
around it, then every node's smaller neighbours; the links shrink to stars
in a number of rounds that grows with the logarithm of the longest path.
Minima are partial aggregates and are joined back, so a hub's neighbours
are never gathered; each round is written, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.llm.common import hot_join, written


def _star(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """``pairs (u, v)`` with the least of each ``u``'s neighbours and ``u`` itself."""
    low = pairs.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("near"))
    low = written(spark, low.withColumn("low", F.least("u", "low")), "star_low")
    return hot_join(pairs, low, "u", "near", max(1, pairs.count()))


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``links (a, b)`` -> ``node, comp``: every linked node with the smallest node it reaches."""
    edges = written(spark, links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "star_edges")
    mark = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark or not state[0]:
            break
        mark = state
        both = written(spark, edges.union(edges.select("v", "u")), "star_both")
        large = _star(spark, both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = written(spark, large.where("u <> v").distinct(), "star_large")
        small = _star(spark, large)
        small = (small.select(F.col("v").alias("x"), "low").union(small.select("u", "low"))
                 .where("x <> low").select(F.col("x").alias("u"), F.col("low").alias("v")).distinct())
        edges = written(spark, small, "star_edges")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .union(edges.select("v", "v").distinct()))
