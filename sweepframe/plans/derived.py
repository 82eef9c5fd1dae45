"""Derived on-disk inputs for the driver queries (logs, stdout files, params, snapshots).

Each builder writes with Spark under the shared work folder and returns the
path; results are reused within one process (keyed by table folder), so a
query suite writes each derived input once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.plans import fixtures as fx
from sweepframe.session import scratch_path, shuffles_dropped
from sweepframe.sources import blockindex, text

HEADER_JSON = '{"header": "true", "date": "2026-01-01T00:00:00Z", "replicates": "1", "site": "local"}'

_cache: dict = {}


def _once(key, build):
    if key not in _cache:
        _cache[key] = build()
    return _cache[key]


#: Blocks are a multiple of this many bytes.
BLOCK_STEP = 16
#: Bytes of a record's keys, brackets, quotes and header line, and (below) of a day's separators: spaces, escaped line end, commas.
FRAME_BYTES, DAY_FRAME_BYTES = 144, 6


def _block_for(spark: SparkSession, sf: str, *more: str) -> int:
    """The least multiple of ``BLOCK_STEP`` that surely holds every record of ``sf``, and the header.

    It bounds a log's blocks, and comes from the longest
    values in the tables: of what a record has once, and of what it has for
    each day (``more`` names further day columns), as often as the order with
    the most lines has days.
    """
    def widest(df, *cols):
        return df.agg(F.max(sum((F.coalesce(F.octet_length(c.cast("string")), F.lit(4)) for c in cols), F.lit(0)))).first()[0] or 0

    def build():
        li, orders = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
        qty, start = F.col("l_quantity"), fx.epoch_seconds("o_orderdate")
        days = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        day = widest(li, qty, qty.cast("long"), F.col("l_discount"), F.col("l_linenumber"), *[F.col(c) for c in more])
        # the priority as JSON escapes it
        once = widest(orders, F.col("o_orderkey"), F.col("o_custkey"), F.to_json(F.struct(F.col("o_orderpriority").alias("c"))),
                      F.year("o_orderdate"), start, start + F.col("o_totalprice") / 100.0)
        digits = len(str(days))
        most = FRAME_BYTES + digits + once + days * (DAY_FRAME_BYTES + len(more) + digits + day)
        return -(-max(most, len(HEADER_JSON)) // BLOCK_STEP) * BLOCK_STEP

    def tidy():
        with shuffles_dropped(spark):
            return build()
    return _once(("block", sf, *more), tidy)


def block_size(spark: SparkSession, sf: str) -> int:
    """Longest block of the D1 log, and of other logs of its records."""
    return _block_for(spark, sf)


def d1_log(spark: SparkSession, sf: str) -> str:
    """The D1 log: a header block, then one block per run, in every part file; a file holds records of like length."""
    def build():
        p = scratch_path(spark, "d1log")
        fx.d1_log(spark, sf, p, header_json=HEADER_JSON, block_size=_block_for(spark, sf), fit=True)
        return p
    return _once(("d1log", sf), build)


def d1_index(spark: SparkSession, sf: str) -> str:
    """The kept index of the D1 log."""
    def build():
        p, log = scratch_path(spark, "d1index"), d1_log(spark, sf)
        blockindex.extend(spark, log, p, "listed")
        blockindex.extend(spark, log, p, "listed")  # nothing new: adds nothing
        return p
    return _once(("d1index", sf), build)


def d1_short_log(spark: SparkSession, sf: str) -> str:
    """D1 variant with a 4th column ``R = l_tax`` that returned items (flag R) lack."""
    def build():
        li = fx.table(spark, sf, "lineitem")
        day = F.struct(
            F.col("l_linenumber").alias("k1"), F.col("l_partkey").alias("k2"),
            F.col("l_suppkey").alias("k3"), F.col("l_extendedprice").alias("k4"),
            F.col("l_shipdate").alias("k5"), F.col("l_quantity").alias("qty"),
            F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
            F.col("l_returnflag").alias("flag"))
        g = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(day)).alias("d"))
        lines = F.transform("d", lambda x, i: F.concat_ws(
            " ", (i + 1).cast("string"), x["qty"].cast("string"), x["disc"].cast("string"),
            F.when(x["flag"] != "R", x["tax"].cast("string"))))
        rec = g.select(F.col("l_orderkey").alias("task_id"), F.lit(0).cast("long").alias("seed"),
                       F.concat(F.lit("Day Su A/I R\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("output_dat"))
        enc = rec.select(fx.to_record_json(rec).alias("value"), "task_id")
        p = scratch_path(spark, "d1short")
        fx.write_shares(spark, sf, enc, p, block_size=_block_for(spark, sf, "l_tax"), fit=True)
        return p
    return _once(("d1short", sf), build)


def file_block() -> Column:
    """Block size of a file of a derived log, by its ``path``."""
    return F.regexp_extract("path", r"/block=(\d+)/[^/]*$", 1).cast("long")


def blocks(spark: SparkSession, path: str, indices=None) -> DataFrame:
    r = (spark.read.format("blocklog").option("blockSize", "listed")
         .option("minPartitions", str(spark.sparkContext.defaultParallelism)))
    if indices is not None:
        r = r.option("blocks", ",".join(str(i) for i in indices))
    return r.load(path)


def stdout_files(spark: SparkSession, sf: str) -> str:
    """The stdout of every events user, each line behind its run's tag (``<user>\\t``), lines in (ts, event_id) order.

    click    -> ``[Day <event_id> of run <user>: <floor(value)>; deaths <user>``
    signup   -> ``TIME: SETUP: <value>``
    purchase -> ``TIME: SIM: <value>``
    error    -> ``EARLY-EXIT at <value>`` when value > 300, else ``error <value>``
    view     -> ``view <value>``
    """
    def build():
        ev = fx.table(spark, sf, "events")
        v = F.col("value").cast("string")
        line = (F.when(F.col("event_type") == "click", F.concat(
                    F.lit("[Day "), F.col("event_id").cast("string"), F.lit(" of run "),
                    F.col("user_id").cast("string"), F.lit(": "), F.floor("value").cast("string"),
                    F.lit("; deaths "), F.col("user_id").cast("string")))
                .when(F.col("event_type") == "signup", F.concat(F.lit("TIME: SETUP: "), v))
                .when(F.col("event_type") == "purchase", F.concat(F.lit("TIME: SIM: "), v))
                .when((F.col("event_type") == "error") & (F.col("value") > 300), F.concat(F.lit("EARLY-EXIT at "), v))
                .otherwise(F.concat(F.col("event_type"), F.lit(" "), v)))
        p = scratch_path(spark, "stdout")
        # Runs are ranged over the files, as a launcher tags the output it
        # gathers: the number of files goes with the bytes, not with the
        # runs.  A run with many lines is split over several tasks/files
        # whose names follow line order.
        tag = F.concat(F.coalesce(F.col("user_id").cast("string"), F.lit("")), F.lit(text.TAG_END))
        tagged = F.concat(tag, F.regexp_replace(F.coalesce("line", F.lit("")), F.lit(r"\r\n|[\r\n]"), F.concat(F.lit("\n"), tag)))
        (ev.select("user_id", "ts", "event_id", line.alias("line"))
           .repartitionByRange("user_id", "ts", "event_id").sortWithinPartitions("user_id", "ts", "event_id")
           .select(tagged.alias("value")).write.mode("overwrite").text(p))
        return p
    return _once(("stdout", sf), build)


def nation_template(spark: SparkSession, sf: str) -> DataFrame:
    """A config template derived from ``nation``: four fixed lines, then
    ``nation.n<key> = <regionkey>`` per nation (line order = nation key)."""
    fixed = spark.createDataFrame(
        [(0, "# template"), (1, "id = 7"), (2, "agent.seed = 1"), (3, "diag.output_filename = out/output.dat")],
        "line_no int, raw string")
    nat = fx.table(spark, sf, "nation").select(
        (F.col("n_nationkey") + 4).alias("line_no"),
        F.concat(F.lit("nation.n"), F.col("n_nationkey").cast("string"), F.lit(" = "),
                 F.col("n_regionkey").cast("string")).alias("raw"))
    return fixed.unionByName(nat).withColumn("file", F.lit("tmpl"))


def params_jsonl(spark: SparkSession, sf: str) -> str:
    """One JSON parameter set per customer (instance = custkey)."""
    def build():
        c = fx.table(spark, sf, "customer")
        line = F.concat(F.lit('{"instance": '), F.col("c_custkey").cast("string"), F.lit(', "nation.n'),
                        F.col("c_nationkey").cast("string"), F.lit('": ['), F.col("c_acctbal").cast("string"),
                        F.lit(", "), F.col("c_nationkey").cast("string"), F.lit('], "replicates": [0, 1]}'))
        p = scratch_path(spark, "params_jsonl")
        c.select(line.alias("value")).write.mode("overwrite").text(p)
        return p
    return _once(("pjsonl", sf), build)


def params_csv(spark: SparkSession, sf: str) -> str:
    """Parameter CSV from ``part`` in ``p_partkey`` order (range-sorted part files)."""
    def build():
        part = fx.table(spark, sf, "part").select(
            F.col("p_partkey").cast("string").alias("part.key"),
            F.col("p_name").alias("part.name"),
            F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(", "),
                     F.col("p_retailprice").cast("string"), F.lit("]")).alias("part.list"),
            F.col("p_partkey").alias("_k"))
        p = scratch_path(spark, "params_csv")
        part.orderBy("_k").drop("_k").write.mode("overwrite").option("header", "true").csv(p)
        return p
    return _once(("pcsv", sf), build)


def params_csvs(spark: SparkSession, sf: str) -> list[str]:
    """Two parameter CSVs with different columns: customers of even keys, then those of odd ones, by key."""
    def build():
        c = fx.table(spark, sf, "customer").orderBy("c_custkey")
        first = c.where("c_custkey % 2 = 0").select(
            F.concat(F.lit("["), F.col("c_acctbal").cast("string"), F.lit(", "), F.col("c_nationkey").cast("string"), F.lit("]")).alias("nation.n0"),
            F.concat(F.lit('say "'), "c_mktsegment", F.lit('"')).alias("nation.n1"))
        second = c.where("c_custkey % 2 = 1").select(
            F.col("c_nationkey").cast("string").alias("nation.n2"), F.col("c_custkey").cast("string").alias("agent.seed"),
            F.col("c_name").alias("unknown.key"))
        paths = []
        for df in (first, second):
            paths.append(scratch_path(spark, "params_csvs"))
            df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(paths[-1])
        return paths
    return _once(("pcsvs", sf), build)


SNAPSHOT_FIELDS = ("agent_idx bigint, status tinyint, infection_prob float, position_x float, workgroup bigint, "
                   "FIPS int, Tract int, withdrawn tinyint")


def snapshots(spark: SparkSession, sf: str) -> str:
    """Agent snapshots from ``lineitem``: seed = return flag, run = line status,
    step directory = ``plt%05d`` of line number, agent = order key.
    ``withdrawn`` is only written from step 1 on."""
    def build():
        li = fx.table(spark, sf, "lineitem")
        g = li.groupBy(
            F.concat(F.lit("SEED"), F.col("l_returnflag")).alias("seed"),
            F.concat(F.lit("run_"), F.col("l_linestatus")).alias("run"),
            F.format_string("plt%05d", F.col("l_linenumber") - 1).alias("plt"),
            F.col("l_orderkey").alias("agent_idx")).agg(
            F.count(F.lit(1)).cast("tinyint").alias("status"),
            F.max("l_discount").cast("float").alias("infection_prob"),
            F.max("l_quantity").cast("float").alias("position_x"),
            F.min("l_partkey").alias("workgroup"))
        g = g.withColumn("FIPS", (F.col("agent_idx") % 97).cast("int")) \
             .withColumn("Tract", (F.col("agent_idx") % 13).cast("int"))
        p = scratch_path(spark, "snapshots")
        first = g.where(F.col("plt") == "plt00000")
        later = g.where(F.col("plt") != "plt00000").withColumn("withdrawn", (F.col("status") > 1).cast("tinyint"))
        first.write.mode("overwrite").partitionBy("seed", "run", "plt").parquet(p)
        later.write.mode("append").partitionBy("seed", "run", "plt").parquet(p)
        return p
    return _once(("snap", sf), build)


def day_tables(spark: SparkSession, sf: str) -> DataFrame:
    """``task_id, output_dat``: per events user who viewed, ``Day Su`` and a line ``<event_id> <value>`` a view."""
    view = fx.table(spark, sf, "events").where("event_type = 'view'")
    lines = view.groupBy(F.col("user_id").alias("task_id")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", F.floor("value").alias("su")))).alias("d"))
    body = F.array_join(F.transform("d", lambda x: F.concat_ws(" ", x["event_id"].cast("string"), x["su"].cast("string"))), "\n")
    return lines.select("task_id", F.concat(F.lit("Day Su\n"), body, F.lit("\n")).alias("output_dat"))


def day_table_files(spark: SparkSession, sf: str) -> str:
    """``output.dat`` text per nation run (``run=<nationkey>/``): header line
    ``Day Su``, then ``<custkey> <acctbal>`` per customer of the nation.
    Range-partitioned on (run, key): a large run spans several files whose
    names follow line order; no run is collected into one row."""
    def build():
        c = fx.table(spark, sf, "customer")
        data = c.select(F.col("c_nationkey").alias("run"), F.col("c_custkey").alias("k"),
                        F.concat_ws(" ", F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string")).alias("value"))
        head = fx.table(spark, sf, "nation").select(F.col("n_nationkey").alias("run"), F.lit(-1).cast("long").alias("k"),
                                                    F.lit("Day Su").alias("value"))
        p = scratch_path(spark, "daytables")
        (head.unionByName(data).repartitionByRange("run", "k").sortWithinPartitions("run", "k")
             .select("run", "value").write.mode("overwrite").partitionBy("run").text(p))
        return p
    return _once(("daytables", sf), build)
