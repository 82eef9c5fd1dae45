"""Sweep-shaped inputs derived from the driver tables.

The driver ships TPC-H-like tables, not block logs.  These derivations
map them onto the sweep data model so every operator runs on data whose
size grows with the tables:

* D1 - one ``orders`` row with its ``lineitem`` rows is one run:
  ``task_id = l_orderkey``, ``params_id = o_custkey``,
  ``cfg_id = o_orderpriority``, ``seed = year(o_orderdate)``,
  ``start`` = order date in epoch seconds, ``stop = start + o_totalprice/100``;
  its line items, ordered by ``(l_linenumber, l_partkey, l_suppkey,
  l_extendedprice, l_shipdate)``, are days 1..n of the day table
  ``Day Su A/I`` with ``Su = l_quantity`` and ``A/I = l_discount``;
  ``infected`` = quantities, ``deaths`` = line numbers.
* D2 - one ``events`` user is one run; ``start``/``stop`` = first/last ``ts``.

The line items of one order form one record.  A record has to fit one
log block, so the per-order collect is bounded by the block size; the
sink fails loudly rather than truncating if it ever is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.functions.records import to_record_json
from sweepframe.session import shuffles_dropped

D1_HEADER_LINE = "Day Su A/I"
#: Orders written by one append of a log, and appends at most (each reads the tables again).
SHARE_ORDERS, MOST_SHARES = 1_000_000, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds(ts_col) -> F.Column:
    """Zone-less timestamp -> epoch seconds as double (no time zone involved)."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                  f"CAST({ts_col} AS TIMESTAMP_NTZ))").cast("double") / 1e6


def d1_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, d array<struct<k..., qty, disc>>) with days in order, one row per order."""
    li = table(spark, sf_dir, "lineitem")
    day = F.struct(
        F.col("l_linenumber").alias("k1"), F.col("l_partkey").alias("k2"),
        F.col("l_suppkey").alias("k3"), F.col("l_extendedprice").alias("k4"),
        F.col("l_shipdate").alias("k5"), F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"))
    return li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(day)).alias("d"))


def d1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 result records (D1): one per order that has line items."""
    days = d1_days(spark, sf_dir)
    lines = F.transform(
        "d", lambda x, i: F.concat_ws(" ", (i + 1).cast("string"), x["qty"].cast("string"),
                                      x["disc"].cast("string")))
    runs = days.select(
        "l_orderkey",
        F.size("d").cast("long").alias("day_final"),
        F.transform("d", lambda x: x["qty"].cast("long")).alias("infected"),
        F.transform("d", lambda x: x["k1"].cast("long")).alias("deaths"),
        F.concat(F.lit(D1_HEADER_LINE + "\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("output_dat"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.col("o_custkey").alias("params_id"),
        F.col("o_orderpriority").alias("cfg_id"),
        F.year("o_orderdate").cast("long").alias("seed"),
        epoch_seconds("o_orderdate").alias("start"),
        (epoch_seconds("o_orderdate") + F.col("o_totalprice") / 100.0).alias("stop"))
    rec = runs.join(orders, runs.l_orderkey == orders.o_orderkey)
    return rec.select(
        "day_final", "infected", "deaths", "output_dat",
        F.col("l_orderkey").alias("task_id"), "cfg_id", "params_id", "seed", "start", "stop")


def write_blocklog(df: DataFrame, path: str, value_col: str = "value", block_size: int = 65536,
                   partition_by: str | None = None, order_by: list[str] | None = None,
                   header_json: str | None = None, mode: str = "overwrite", fit: bool = False) -> str:
    """S7 helper: write ``value_col`` as one block per row.

    With ``fit`` records of like length share a file, whose blocks are at most
    an eighth (or 15 bytes) longer than its records, and ``block_size`` is the
    longest block: padding is a small share of the log, whatever one record
    has.  A task writes a file per length, of which there are eight a doubling.
    Such files are compressed.
    """
    out = df
    if fit:
        n = F.greatest(F.octet_length(value_col), F.lit(len((header_json or "").encode())), F.lit(1))
        step = F.call_function("shiftleft", F.lit(1), F.greatest(F.length(F.bin(n)) - 4, F.lit(4)))
        partition_by = "block"
        out = out.withColumn("block", F.least(F.lit(block_size), (F.ceil(n / step) * step).cast("int")))
    if partition_by:
        # each task writes one file per key it holds: a hot key is spread over
        # many tasks and files instead of being funnelled into one
        out = out.sortWithinPartitions(partition_by, *(order_by or []))
    elif order_by:
        out = out.sortWithinPartitions(*order_by)
    cols = [F.col(value_col).alias("value")] + ([F.col(partition_by)] if partition_by else [])
    w = out.select(*cols).write.format("blocklog").mode(mode).option("blockSize", str(block_size))
    if partition_by:
        w = w.option("sizedBy" if fit else "partitionBy", partition_by)
    if fit:
        w = w.option("compression", "zstd")
    if header_json is not None:
        w = w.option("headerJson", header_json)
    w.save(path)
    return path


def write_shares(spark: SparkSession, sf_dir: str, df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    """``write_blocklog`` of records by ``task_id``.  Those of many orders are written as several appends, each of a
    share of the orders and all their lines, so that on disk the log meets the shuffle of one share only."""
    shares = min(MOST_SHARES, -(-table(spark, sf_dir, "orders").count() // SHARE_ORDERS)) or 1
    with shuffles_dropped(spark):
        for i in range(shares):
            share = df.where(F.pmod(F.xxhash64("task_id"), F.lit(shares)) == i) if shares > 1 else df
            write_blocklog(share, path, mode="append" if i else mode, order_by=["task_id"], **options)
    return path


def d1_log(spark: SparkSession, sf_dir: str, path: str, header_json: str | None = None,
           partition_by: str | None = None, block_size: int = 65536, fit: bool = False) -> str:
    rec = d1_records(spark, sf_dir)
    enc = rec.select(to_record_json(rec).alias("value"), "params_id", "task_id", "seed")
    return write_shares(spark, sf_dir, enc, path, block_size=block_size, partition_by=partition_by,
                        header_json=header_json, fit=fit)


def d2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per events user with start/stop = first/last event time (epoch seconds)."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("user_id").agg(
        F.min(epoch_seconds("ts")).alias("start"),
        F.max(epoch_seconds("ts")).alias("stop"),
        F.count(F.lit(1)).alias("n_events"))
