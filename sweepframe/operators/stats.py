"""Run-time and outcome statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sweepframe.functions.records import split_header
from sweepframe.sources.blocklog import unpacked_length

# Stdout timing lines and the early-exit marker.
SETUP_RE = r"^TIME:\s*SETUP:\s*([0-9.]+)"
SIM_RE = r"^TIME:\s*SIM:\s*([0-9.]+)"
EARLY_MARK = "EARLY-EXIT"
PREVIEW_WIDTH = 80

# Exact median: ranges counted in one step, and steps before the values left are ranked.
RANGES = 4096
NARROWINGS = 2


def conversion_summary(records: DataFrame, long_rows: DataFrame, files: DataFrame,
                       block_size: int | Column) -> DataFrame:
    """Records read, rows written, expected blocks (= file size / block; a column of ``files`` where that differs)."""
    r = records.agg(F.count(F.lit(1)).alias("records"))
    n = long_rows.select(F.count(F.lit(1))).scalar()
    b = files.select(F.sum(F.floor(F.col("length") / block_size)).cast("long")).scalar()
    return r.select("records", n.alias("rows"), b.alias("expected_blocks"))


def run_durations(records: DataFrame) -> DataFrame:
    """``stop - start`` for each record that has both (narrow, no shuffle)."""
    return records.where(F.col("start").isNotNull() & F.col("stop").isNotNull()).select(
        "path", "block_idx", "task_id", (F.col("stop") - F.col("start")).alias("duration"))


def durations(records: DataFrame) -> DataFrame:
    """Run durations with a running index in log order (path, block)."""
    from sweepframe.operators.sweep import index_rows

    return index_rows(run_durations(records), "idx", order_by=["path", "block_idx"], start=0)


def duration_stats(d: DataFrame) -> DataFrame:
    """Count, min, max, mean, total of durations (partial + final aggregate).
    ``d`` is ``run_durations`` output (the running index is not needed)."""
    return d.agg(F.count("duration").alias("count"), F.min("duration").alias("min"),
                 F.max("duration").alias("max"), F.avg("duration").alias("mean"),
                 F.sum("duration").alias("total"))


def stdout_timings(stdout: DataFrame, file: str = "file") -> DataFrame:
    """Per stdout file: last SETUP and SIM values and an early-exit flag.

    First per file split, by a plain position (fixed-width buffers, so a hash
    aggregate that combines on the scan's side), then over a run's few splits.
    """
    setup = F.regexp_extract("line", SETUP_RE, 1)
    sim = F.regexp_extract("line", SIM_RE, 1)
    is_setup = F.col("line").rlike(SETUP_RE)
    setup_v = F.when(is_setup, setup.try_cast("double"))
    sim_v = F.when(~is_setup & F.col("line").rlike(SIM_RE), sim.try_cast("double"))
    chunk = [f.name for f in stdout.schema["line_key"].dataType.fields if f.name != "pos"]
    per = stdout.select(F.col(file).alias("_run"), *[F.col("line_key")[c].alias(f"_{c}") for c in chunk],
                        F.col("line_key.pos").alias("_pos"), setup_v.alias("sv"), sim_v.alias("mv"),
                        F.col("line").contains(EARLY_MARK).alias("early"))
    keys = [f"_{c}" for c in chunk]

    def last(value: str, order: Column) -> Column:
        return F.max_by(value, F.when(F.col(value).isNotNull(), order)).alias(value)

    split = per.groupBy("_run", *keys).agg(last("sv", F.col("_pos")), last("mv", F.col("_pos")), F.max("early").alias("early"))
    order = F.struct(*keys) if keys else F.lit(0)
    return split.groupBy("_run").agg(last("sv", order), last("mv", order), F.max("early").alias("early")).select(
        F.col("_run").alias(file), F.col("sv").alias("setup"), F.col("mv").alias("sim"), "early")


def split_early(timings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(early files, the rest)."""
    return timings.where("early"), timings.where("not early")


def timing_summary(timings: DataFrame) -> DataFrame:
    """Per series SETUP, SIM, TOTAL (both present), over non-early files:
    n, min, max, mean, median, total.  An empty series gives n = 0 and nulls."""
    _, ok = split_early(timings)
    long = ok.select(F.explode(F.array(
        F.struct(F.lit("SETUP").alias("series"), F.col("setup").alias("v")),
        F.struct(F.lit("SIM").alias("series"), F.col("sim").alias("v")),
        F.struct(F.lit("TOTAL").alias("series"), (F.col("setup") + F.col("sim")).alias("v")))).alias("x"))
    long = long.select("x.series", "x.v").where(F.col("v").isNotNull())
    # distinct values with their counts: one shuffle, which every later step reads again
    counted = long.groupBy("series", "v").agg(F.count(F.lit(1)).alias("times"))
    agg = counted.groupBy("series").agg(
        F.sum("times").alias("n"), F.min("v").alias("min"), F.max("v").alias("max"),
        (F.sum(F.col("v") * F.col("times")) / F.sum("times")).alias("mean"),
        F.sum(F.col("v") * F.col("times")).alias("total"))
    agg = agg.join(median_of_counts(counted, "series", "v", "times"), "series", "left")
    spark = timings.sparkSession
    names = spark.createDataFrame([("SETUP",), ("SIM",), ("TOTAL",)], "series string")
    out = names.join(agg, "series", "left")
    return out.withColumn("n", F.coalesce("n", F.lit(0).cast("long")))


def exact_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact (interpolated) median per group; null values take no part.

    ``group`` names a few series: two rows of each are broadcast."""
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("_times"))
    return median_of_counts(counted, group, value, "_times")


def median_of_counts(counted: DataFrame, group: str, value: str, times: str) -> DataFrame:
    """Exact median per group of distinct values with counts, by selection.

    The two middle ranks are looked for at once.  A step counts the values of
    a rank's range in ``RANGES`` equal ranges between its least and greatest
    value, and narrows to the one that holds the rank; the last step ranks the
    distinct values that are left.  Nothing is sorted as a whole and nothing is
    run while the plan is built; every step reads the shuffle of ``counted``.
    """
    v, n = F.col(value).cast("double"), F.col(times)
    base = counted.select(F.col(group).alias("_g"), v.alias("_v"), n.alias("_n"))
    size = base.groupBy("_g").agg(F.sum("_n").alias("_all"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranks = F.array(F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2))
    picks = size.select("_g", F.posexplode(ranks).alias("_which", "_rank"), F.lit(0).cast("long").alias("_below"), "_lo", "_hi")
    held = Window.partitionBy("_g", "_which").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    width = F.col("_hi") - F.col("_lo")
    for step in range(NARROWINGS + 1):
        if step < NARROWINGS:
            cut = F.least(F.floor((F.col("_v") - F.col("_lo")) / width * RANGES), F.lit(RANGES - 1).cast("long"))
            where = F.when(width > 0, cut).otherwise(F.lit(0).cast("long"))
        else:
            where = F.col("_v")
        inside = base.join(F.broadcast(picks), "_g").where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        bins = inside.groupBy("_g", "_which", "_rank", "_below", where.alias("_bin")).agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.col("_below") + F.sum("_n").over(held)
        picks = (bins.withColumn("_upto", upto)
                 .where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
                 .select("_g", "_which", "_rank", (F.col("_upto") - F.col("_n")).alias("_below"), "_lo", "_hi"))
    return picks.groupBy("_g").agg(F.avg("_lo").alias("median")).withColumnRenamed("_g", group)


def log_stat(spark: SparkSession, path: str, records: DataFrame, block_size: int | Column) -> DataFrame:
    """Per log file: size, mtime, content blocks, and its header pairs.

    Sizes come from a listing (``binaryFile`` without reading content) and
    are those on disk; blocks are counted in the unpacked content.  The
    block size may be an expression over a file's ``path``.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.log")
             .option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_replace("path", "^file:", "").alias("path"), "length", "modificationTime"))
    header, _ = split_header(records)
    h = header.select("path", F.explode("meta").alias("key", "value"))
    blocks = F.greatest(F.ceil(unpacked_length(F.col("path"), F.col("length")) / block_size) - 1, F.lit(0)).cast("long")
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"),
                        blocks.alias("content_blocks")).join(h, "path", "left")


def run_counts(records: DataFrame, group: str = "params_id") -> DataFrame:
    """Successes (record text not empty) per params row, plus the total
    (row with null ``params_id``) via rollup."""
    return records.rollup(group).agg(
        F.count_if(F.length("json") > 0).alias("n_ok"), F.grouping(group).alias("is_total"))


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows (top-k by ``order_by``), every value shown as text
    cut at 80 characters with a length note."""
    top = df.orderBy(*order_by).limit(n)

    def cut(c):
        s = F.col(c).cast("string")
        return F.when(F.length(s) > PREVIEW_WIDTH, F.concat(
            F.substring(s, 1, PREVIEW_WIDTH), F.lit("... ("), F.length(s).cast("string"), F.lit(" chars)"))
        ).otherwise(s).alias(c)

    return top.select(*[cut(c) for c in df.columns])


def describe(spark: SparkSession, path: str) -> DataFrame:
    """R20 header part: row count, column count, schema and stored header
    pairs of a long table, as sorted (key, value) rows.  The row count reads
    no column (an empty read schema: Parquet row counts alone)."""
    from sweepframe.sources.longtable import read_header

    df = spark.read.parquet(path)
    n = df.select(F.count(F.lit(1))).scalar()
    meta = sorted(read_header(spark, path).items())
    static = [("columns", str(len(df.columns))), ("schema", df.schema.simpleString())]
    static += [(f"meta.{k}", str(v)) for k, v in meta]
    base = spark.createDataFrame(static, "key string, value string")
    return base.unionByName(spark.range(1).select(F.lit("rows").alias("key"), n.cast("string").alias("value")))
