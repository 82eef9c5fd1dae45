"""Validation of a long table against its source log (V1-V5).

Each check returns a small DataFrame; ``validate`` unions them into one
verdict.  Rows and values are reconciled by one order-free fingerprint per
run on either side; only runs whose fingerprints differ are compared cell by
cell, each ``(row_id, Day, column)`` as a multiset, so nothing is positional
and days that repeat are no mismatch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sweepframe.functions.daytable import LONG_VALUE_COLUMNS, edge_trim, ws_split
from sweepframe.session import scratch_path, shuffles_dropped

MAGIC = b"PAR1"


def check_magic(spark: SparkSession, path: str) -> DataFrame:
    """V1: first and last 4 bytes of every Parquet part file are ``PAR1``.

    Files are listed without reading content; each task opens its files
    and reads 8 bytes.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(path).select("path", "length"))

    def probe(batches):
        import pandas as pd

        from sweepframe.sources.blocklog import _open_read

        for pdf in batches:
            ok = []
            for p, n in zip(pdf["path"], pdf["length"]):
                with _open_read(p) as f:
                    head = f.read(4)
                    f.seek(max(int(n) - 4, 0))
                    tail = f.read(4)
                ok.append(head == MAGIC and tail == MAGIC)
            yield pd.DataFrame({"path": pdf["path"], "ok": ok})

    return files.mapInPandas(probe, "path string, ok boolean")


def check_schema(spark: SparkSession, out: StructType, ref: StructType | None) -> DataFrame:
    """V2: ordered (name, type) pairs equal the reference; no reference -> SKIP.

    Schemas are metadata: the position-by-position comparison is made from
    the two field lists and returned as a small table (no job over data).
    """
    from itertools import zip_longest

    ddl = "pos int, name string, type string, ref_name string, ref_type string, status string"
    if ref is None:
        return spark.createDataFrame([(None, None, None, None, None, "SKIP")], ddl)
    rows = []
    for i, (a, b) in enumerate(zip_longest(out.fields, ref.fields)):
        na, ta = (a.name, a.dataType.simpleString()) if a else (None, None)
        nb, tb = (b.name, b.dataType.simpleString()) if b else (None, None)
        ok = a is not None and b is not None and na == nb and ta == tb
        rows.append((i, na, ta, nb, tb, "OK" if ok else "MISMATCH"))
    return spark.createDataFrame(rows, ddl)


def expected_lines(records: DataFrame, with_short: bool = False) -> DataFrame:
    """Source values re-read from the text, independently of the converter:
    the header is the first NON-blank line, every later non-blank line with at
    least as many tokens is a data line.  Output per data line: ``row_id``,
    ``src_seed``, ``Day``, ``full`` (enough tokens) and, per column,
    ``want_<c>`` (the value as the table's float type holds it, 0 when the
    header lacks the column) and ``has_<c>`` (the header has it).  Header
    positions are found once per record.
    With ``with_short`` the lines with too few tokens are kept (they count
    for V3) with null values."""
    lines = F.filter(F.split(F.col("output_dat"), "\n"), lambda x: edge_trim(x) != "")
    per = records.where(F.col("output_dat").isNotNull()).select(
        F.coalesce("task_id", F.lit(0).cast("long")).alias("row_id"),
        F.coalesce("seed", F.lit(0).cast("long")).alias("src_seed"),
        F.transform(ws_split(edge_trim(F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit("")))),
                    lambda x: F.replace(x, F.lit("/"), F.lit("_"))).alias("hdr"),
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("body"))
    n = F.size("hdr")

    def last_pos(name):
        r = F.array_position(F.col("rhdr"), F.lit(name))
        return F.when(r > 0, n - r)

    cols = ["Day"] + LONG_VALUE_COLUMNS
    per_pos = per.withColumn("rhdr", F.reverse("hdr")).select(
        "row_id", "src_seed", n.alias("n"),
        F.coalesce(last_pos("Day"), F.lit(0)).alias("p_Day"),
        *[last_pos(c).alias(f"p_{c}") for c in LONG_VALUE_COLUMNS], "body")
    exploded = per_pos.select("row_id", "src_seed", "n", *[f"p_{c}" for c in cols],
                              F.explode("body").alias("line"))
    tok = exploded.select("*", ws_split(edge_trim(F.col("line"))).alias("tok"))
    if not with_short:
        tok = tok.where(F.size("tok") >= F.col("n"))
    full = F.size("tok") >= F.col("n")

    def want(c):
        value = F.get(F.col("tok"), F.col(f"p_{c}")).try_cast("float").cast("double")
        return F.when(full, F.when(F.col(f"p_{c}").isNull(), F.lit(0.0)).otherwise(value))

    return tok.select(
        "row_id", "src_seed", F.get(F.col("tok"), F.col("p_Day")).try_cast("int").alias("Day"), full.alias("full"),
        *[want(c).alias(f"want_{c}") for c in LONG_VALUE_COLUMNS],
        *[F.col(f"p_{c}").isNotNull().alias(f"has_{c}") for c in LONG_VALUE_COLUMNS])


_CHECKED = ["seed"] + LONG_VALUE_COLUMNS


def _fingerprint(day, seed, values, when=None):
    """Order-free hash of rows: two sums over the halves of each row's hash (they cannot overflow before 2^31 rows)."""
    h = F.xxhash64(day.cast("int"), seed.cast("long"), *[v.cast("float") for v in values])
    h = h if when is None else F.when(when, h)
    return [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high")]


def fingerprints(long_df: DataFrame, records: DataFrame) -> DataFrame:
    """V3 + V4, first pass: ``row_id, rows, expected, no_day, same`` per run.

    Either side is one aggregate per run (partial sums, so a hot run costs
    one row a task): the rows and the fingerprint of ``(Day, seed, values)``
    of the table, and of the lines with enough tokens of the log.  ``same``
    says that the two are equal as multisets of rows.
    """
    table = long_df.groupBy("row_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Day").isNull()).alias("no_day"),
        *_fingerprint(F.col("Day"), F.col("seed"), [F.col(c) for c in LONG_VALUE_COLUMNS]))
    lines = expected_lines(records, with_short=True)
    source = lines.groupBy("row_id").agg(
        F.count(F.lit(1)).alias("expected"), F.count_if("full").alias("n_full"),
        *[c.alias(f"src_{n}") for c, n in zip(_fingerprint(
            F.col("Day"), F.col("src_seed"), [F.col(f"want_{c}") for c in LONG_VALUE_COLUMNS], F.col("full")), ("low", "high"))])
    both = table.join(source, "row_id", "full_outer")
    same = (F.col("rows") == F.col("n_full")) & F.col("low").eqNullSafe(F.col("src_low")) & F.col("high").eqNullSafe(F.col("src_high"))
    count = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("rows", "expected", "no_day")]
    return both.select("row_id", *count, F.coalesce(same, F.lit(False)).alias("same"))


def bad_cells(long_df: DataFrame, records: DataFrame, runs: DataFrame, tol: float = 1e-6) -> DataFrame:
    """V4, second pass: the mismatching cells ``row_id, Day, column`` of runs whose fingerprints differ.

    A cell's values are put in order on either side and met by rank, which
    fits a multiset within ``tol`` wherever that is possible; ``seed`` must
    be exact.  A null in the table where the source has a value is a
    mismatch, and so is a value other than 0 in a column that the header
    lacks.  Only days that both sides have are compared (the others are row
    mismatches).  Runs that agree are dropped before a line is split.
    """
    differ = runs.where("NOT same").select("row_id")
    src_id = F.coalesce("task_id", F.lit(0).cast("long"))
    some = records.join(differ, src_id == differ["row_id"], "left_semi")

    def ranked(df, columns, name):
        cells = df.select("row_id", "Day", F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), v.cast("double").alias(name)) for c, v in columns])).alias("x")).select("row_id", "Day", "x.*")
        order = W.partitionBy("row_id", "Day", "column").orderBy(F.asc_nulls_first(name))
        return cells.withColumn("at", F.row_number().over(order))

    got = ranked(long_df.join(differ, "row_id", "left_semi"), [(c, F.col(c)) for c in _CHECKED], "got")
    want = ranked(expected_lines(some), [("seed", F.col("src_seed")), *[(c, F.col(f"want_{c}")) for c in LONG_VALUE_COLUMNS]], "want")
    far = F.abs(F.col("got") - F.col("want")) > F.when(F.col("column") == "seed", 0.0).otherwise(tol)
    met = got.join(want, ["row_id", "Day", "column", "at"])
    return met.where(F.col("want").isNotNull() & F.coalesce(far, F.lit(True))).select("row_id", "Day", "column").distinct()


def _row_status():
    return (F.when(F.col("rows") == 0, "MISSING").when(F.col("expected") == 0, "EXTRA")
            .when(F.col("rows") == F.col("expected"), "OK").otherwise("MISMATCH"))


def check_rows(long_df: DataFrame, records: DataFrame) -> DataFrame:
    """V3: rows per run in the table vs data lines in the source records.

    Output per ``row_id``: ``rows``, ``expected``, ``status`` (OK / MISMATCH /
    MISSING = run absent from the table / EXTRA = run absent from the log).
    A record's lines are counted in place (non-blank ones but the header);
    both sides are counts per run before they meet.
    """
    lines = F.filter(F.split(F.col("output_dat"), "\n"), lambda x: edge_trim(x) != "")
    src = (records.where(F.col("output_dat").isNotNull())
           .select(F.coalesce("task_id", F.lit(0).cast("long")).alias("row_id"), (F.size(lines) - 1).cast("long").alias("n"))
           .where("n > 0").groupBy("row_id").agg(F.sum("n").alias("expected")))
    got = long_df.groupBy("row_id").agg(F.count(F.lit(1)).alias("rows"))
    both = got.join(src, "row_id", "full_outer").select(
        "row_id", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.coalesce("expected", F.lit(0)).cast("long").alias("expected"))
    return both.select("row_id", "rows", "expected", _row_status().alias("status"))


def _differing(long_df: DataFrame, records: DataFrame) -> DataFrame:
    """``row_id`` of the runs whose fingerprints differ, kept in the shared folder: their number is known before the rest is planned."""
    spark = long_df.sparkSession
    path = scratch_path(spark, "differing")
    with shuffles_dropped(spark):
        fingerprints(long_df, records).where("NOT same").select("row_id").write.parquet(path)
    return spark.read.parquet(path)


def check_values(long_df: DataFrame, records: DataFrame, tol: float = 1e-6) -> DataFrame:
    """V4 on its own: every table value equals the source text within ``tol``
    (a null does not); ``seed`` exact.  Output per column: ``column, n_checked,
    n_bad`` ((table row, source line) pairs of a day; those of a cell that
    agrees as a multiset are not bad).  A column that no header has is listed
    if it holds anything but 0.

    Pairs are counted from the table's rows a day and, per source line, which
    columns have a value; values meet only for the days that mismatch.
    ``validate`` gets the same answer from the fingerprints, and reads the log once.
    """
    present = [F.when(F.col(f"has_{c}") & F.col(f"want_{c}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(LONG_VALUE_COLUMNS)]
    lines = expected_lines(records).select("row_id", "Day", reduce(lambda a, b: a.bitwiseOR(b), present).alias("present"))
    pairs = long_df.groupBy("row_id", "Day").agg(F.count(F.lit(1)).alias("n")).join(lines, ["row_id", "Day"])
    checked = pairs.agg(F.sum("n").alias("n_seed"), *[
        F.sum(F.when(F.col("present").bitwiseAND(F.lit(1 << i)) != 0, F.col("n"))).alias(f"n_{c}") for i, c in enumerate(LONG_VALUE_COLUMNS)])
    cells = value_cells(long_df, records, tol)
    found = cells.agg(F.count_if(_bad_seed()).alias("b_seed"), *[F.count_if(_bad(c, tol)).alias(f"b_{c}") for c in LONG_VALUE_COLUMNS])
    totals = checked.withColumn("one", F.lit(1)).join(found.withColumn("one", F.lit(1)), "one")
    rows = totals.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(f"n_{c}", F.lit(0)).cast("long").alias("n_checked"), F.col(f"b_{c}").alias("n_bad"))
        for c in _CHECKED])).alias("x"))
    return rows.select("x.*").where((F.col("n_checked") > 0) | (F.col("n_bad") > 0))


def value_cells(long_df: DataFrame, records: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Table rows joined with their source lines on ``(row_id, Day)``, of the days that mismatch: ``bad`` has the columns (at most all of them).

    Without a run whose fingerprints differ neither side is read again.
    """
    differ = _differing(long_df, records)
    if not differ.limit(1).count():
        long_df, records = long_df.where("false"), records.where("false")
    bad = bad_cells(long_df, records, differ.withColumn("same", F.lit(False)), tol)
    bad = bad.groupBy("row_id", "Day").agg(F.collect_set("column").alias("bad"))
    some = records.join(differ, F.coalesce("task_id", F.lit(0).cast("long")) == differ["row_id"], "left_semi")
    return long_df.join(differ, "row_id", "left_semi").join(bad, ["row_id", "Day"]).join(expected_lines(some), ["row_id", "Day"])


def _is_bad(c: str):
    return F.coalesce(F.array_contains("bad", F.lit(c)), F.lit(False))


def _bad(c: str, tol: float):
    far = F.abs(F.col(c).cast("double") - F.col(f"want_{c}")) > tol
    return _is_bad(c) & F.col(f"want_{c}").isNotNull() & F.coalesce(far, F.lit(True))  # null in the table: nothing stands for the value


def _bad_seed():
    return _is_bad("seed") & F.coalesce(F.col("seed") != F.col("src_seed"), F.lit(True))


def value_mismatches(long_df: DataFrame, records: DataFrame, tol: float = 1e-6) -> DataFrame:
    """V4 detail: every mismatching cell (row_id, Day, column, got, want)."""
    j = value_cells(long_df, records, tol)
    cells = [F.struct(F.lit("seed").alias("column"), F.col("seed").cast("double").alias("got"),
                      F.col("src_seed").cast("double").alias("want"),
                      _bad_seed().alias("bad"))]
    cells += [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("got"),
                       F.col(f"want_{c}").alias("want"), _bad(c, tol).alias("bad")) for c in LONG_VALUE_COLUMNS]
    bad = F.filter(F.array(*cells), lambda x: x["bad"])
    return j.select("row_id", "Day", F.explode(bad).alias("x")).select("row_id", "Day", "x.column", "x.got", "x.want")


def validate(spark: SparkSession, long_path: str, records: DataFrame,
             ref_schema: StructType | None = None, tol: float = 1e-6) -> DataFrame:
    """V5: one row per check (check, failures, status) and a final verdict row."""
    long_df = spark.read.parquet(long_path)
    magic = check_magic(spark, long_path).agg(
        F.lit("magic").alias("check"), F.count_if(~F.col("ok")).alias("failures"))
    schema = check_schema(spark, long_df.schema, ref_schema).agg(
        F.lit("schema").alias("check"), F.count_if(F.col("status") == "MISMATCH").alias("failures"))
    # one pass over log and table gives a row per run, kept in the shared folder; runs that differ are few, or the table is bad
    path = scratch_path(spark, "fingerprints")
    fingerprints(long_df, records).write.parquet(path)
    runs = spark.read.parquet(path)
    rows = runs.agg(F.count_if(_row_status() != "OK").alias("rows"), F.coalesce(F.sum("no_day"), F.lit(0)).alias("no_day"))
    if runs.where("NOT same").limit(1).count():
        cells = bad_cells(long_df, records, runs, tol).agg(F.count(F.lit(1)).alias("cells"))
    else:
        cells = spark.range(1).select(F.lit(0).cast("long").alias("cells"))
    both = rows.withColumn("one", F.lit(1)).join(cells.withColumn("one", F.lit(1)), "one").select(
        "rows", (F.col("cells") + F.col("no_day")).alias("values"))
    rv = both.select(F.explode(F.array(
        F.struct(F.lit("rows").alias("check"), F.col("rows").alias("failures")),
        F.struct(F.lit("values").alias("check"), F.col("values").alias("failures")))).alias("x")).select("x.*")
    # the verdict is made from the same rows, so that nothing is read twice
    four = magic.unionByName(schema).unionByName(rv).agg(F.collect_list(F.struct("check", "failures")).alias("rows"))
    failed = F.size(F.filter("rows", lambda r: r["failures"] > 0)).cast("long")
    every = F.concat("rows", F.array(F.struct(F.lit("verdict").alias("check"), failed.alias("failures"))))
    return (four.select(F.explode(every).alias("x")).select("x.*")
            .withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL")))
