"""Small helpers shared by the operators: fresh names, written stages, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.session import prepare, scratch_path

#: Largest number of rows (of a few dozen bytes) that is ever broadcast.
BROADCAST_ROWS = 1_000_000

#: ASCII white space, as every contract here counts it.
SPACE = r"[\x20\x09-\x0D]"


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends here,
    so a lost executor costs a re-read and not a recomputation."""
    prepare(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(spark: SparkSession, docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and that column's name.

    The ids themselves, where a count shows that none is null or repeated;
    else row numbers, in a written copy so that they stay the same.
    """
    rid = fresh(docs, "rid")
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("i")).agg(F.count(F.lit(1)).alias("n"))
    if not ids.where("i IS NULL OR n > 1").limit(1).count():
        return docs.withColumn(rid, F.col("doc_id").cast("long")), rid
    return written(spark, docs.withColumn(rid, F.monotonically_increasing_id()), name), rid


def maybe_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted ``rows`` are within ``limit``;
    otherwise leave the join to the shuffle."""
    return F.broadcast(df) if rows <= limit else df.hint("merge")


def hot_join(big: DataFrame, small: DataFrame, key: str, n: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``big`` with one row per key of ``small`` when a key may hold any share of ``big``.

    ``small[n]`` is the key's row count in ``big``.  At most 1,000 keys can
    hold more than ``total / 1000`` rows each; those few are broadcast, so
    their rows stay where they are.  The other keys go through the shuffle,
    as do all when none is that frequent.
    """
    limit = max(1000, -(-total // 1000))
    hot = F.col(n) > limit
    if not small.where(hot).limit(1).count():
        return big.join(small, key, how)
    heavy, light = F.broadcast(small.where(hot)), small.where(~hot)
    a = big.join(heavy, key, "inner")
    b = big.join(F.broadcast(small.where(hot).select(key)), key, "left_anti").join(light, key, how)
    return a.unionByName(b)


def blank(c: str | Column) -> Column:
    """Null text reads as empty."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_batches(spark: SparkSession, records: int = 2048, size: int = 16 << 20) -> None:
    """Bound the Arrow batches that Python tasks get, by rows and by bytes: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
