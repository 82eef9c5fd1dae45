"""Hot keys: one run holding most rows is split over tasks and files and stays correct."""

import os

from pyspark.sql import functions as F

from sweepframe.functions.daytable import explode_day_lines
from sweepframe.plans.fixtures import write_blocklog
from sweepframe.sources import text


def test_hot_run_day_table_files(spark, tmp):
    # run 0 holds 90% of all lines
    n = 20000
    data = spark.range(n).select(F.when(F.col("id") < n * 0.9, 0).otherwise(F.col("id") % 5 + 1).alias("run"),
                                 F.col("id").alias("k"))
    lines = data.select("run", "k", F.concat_ws(" ", F.col("k").cast("string"), (F.col("k") * 2).cast("string")).alias("value"))
    head = spark.range(6).select(F.col("id").alias("run"), F.lit(-1).cast("long").alias("k"), F.lit("Day Su").alias("value"))
    out = os.path.join(tmp, "dt")
    (head.unionByName(lines).repartitionByRange(8, "run", "k").sortWithinPartitions("run", "k")
         .select("run", "value").write.partitionBy("run").text(out))
    files = [f for f in os.listdir(os.path.join(out, "run=0")) if f.endswith(".txt")]
    assert len(files) > 1  # the hot run was written by several tasks
    runs = spark.range(6).select(F.col("id").alias("task_id"), F.lit(0).cast("long").alias("params_id"),
                                 F.lit(0).cast("long").alias("seed"))
    got = explode_day_lines(runs, text.read_day_table_lines(spark, out, r"run=(\d+)/"))
    agg = got.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("Su") - 2 * F.col("Day")).alias("d"))
    res = {r.row_id: (r.n, r.d) for r in agg.collect()}
    assert res[0] == (int(n * 0.9), 0.0) and sum(v[0] for v in res.values()) == n


def test_hot_key_log_sink(spark, tmp):
    out = os.path.join(tmp, "hot")
    df = spark.range(0, 5000, 1, 8).select(
        F.format_string('{"task_id": %d}', "id").alias("value"),
        F.when(F.col("id") < 4000, 0).otherwise(1).alias("k"), "id")
    write_blocklog(df, out, block_size=64, partition_by="k", order_by=["id"])
    hot = [f for f in os.listdir(os.path.join(out, "k=0")) if f.endswith(".log")]
    assert len(hot) >= 6  # not funnelled into one task
    total = spark.read.format("blocklog").option("blockSize", "64").load(out).count()
    assert total == 5000
