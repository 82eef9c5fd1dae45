"""Text and table sources of a sweep.

Line order inside a file matters for several operators ("last value
wins", per-run series).  Line-mode scans keep it without a per-file sort:
``line_key`` = (file split start, monotonically increasing id) grows
with the position in the file, and only small per-file results are
grouped on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Fixed value: a config line is `prefix key eq value` with key = [\w.]+
CONFIG_LINE = r"^(\s*)([\w.]+)(\s*=\s*)(.*?)$"

MANIFEST_SCHEMA = StructType([
    StructField("fname", StringType()),
    StructField("seed", IntegerType()),
    StructField("p_trans", DoubleType()),
])


# ---------------------------------------------------------------- S9 / S10

def read_params_csv(spark: SparkSession, path: str, reject_blank: bool = True) -> DataFrame:
    """Parameter CSV, all values kept as text; a short row fails the read.

    Quoted fields may hold commas.  Column pruning of the CSV parser is
    switched off (see ``session.prepare``) so a width mismatch raises even
    when only some columns are selected.  Every file's header must name the
    same columns in the same order (checked against the first).  The CSV reader skips blank lines;
    with ``reject_blank`` a blank line is an error, as a parameter row must
    not be empty (checked with one distributed count over the text).
    """
    if reject_blank:
        blank = spark.read.text(path).where(F.trim("value") == "").limit(1).count()
        if blank:
            raise ValueError(f"parameter CSV {path} has a blank line")
    header = spark.read.option("header", "true").csv(path).schema
    schema = StructType([StructField(f.name, StringType()) for f in header.fields])
    return (spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST")
            .option("enforceSchema", "false").option("multiLine", "false").csv(path))


#: Files whose headers are broadcast to their rows; beyond, the join is a shuffle.
HEADER_FILES = 10_000

# a field behind its comma: quoted (doubled quotes inside) or plain
_CSV_FIELD = r',("[^"]*(?:""[^"]*)*"|[^,]*)'


def csv_fields(line: Column) -> Column:
    """A CSV line's fields as text; a field that begins with a quote must end with its pair, or the job fails."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_CSV_FIELD), 1)
    whole = F.length(F.array_join(found, ",")) == F.length(line)
    loose = F.exists(found, lambda t: t.startswith('"') & ~t.rlike(r'^"[^"]*(?:""[^"]*)*"$'))
    plain = F.transform(found, lambda t: F.when(t.startswith('"'), F.replace(F.substr(t, F.lit(2), F.length(t) - 2), F.lit('""'), F.lit('"'))).otherwise(t))
    bad = F.raise_error(F.concat(F.lit("malformed CSV line: "), line)).cast("array<string>")
    return F.when(whole & ~loose, plain).otherwise(bad)


def read_params_csvs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several parameter CSVs, each file with a header of its own.

    Output: ``file`` (sorted as the paths were given, then by name),
    ``line_key``, ``params`` map of the row's values by its file's header.
    ``sweep.index_in_file_order`` numbers the rows over all files.  Blank
    lines are skipped, fields beyond the header are dropped, a short row
    fails the job, and of columns of one name the last counts.  Lines are read
    as text, so a large file is read by many tasks; only the headers, a row
    a file, are brought together.
    """
    parts = []
    for i, path in enumerate(paths):
        full = spark.read.text(path).where(F.trim("value") != "")  # positions count the rows that stay
        lines = full.select(F.col("value").alias("line"), *line_key_cols())
        parts.append(lines.withColumn("file", F.concat(F.lit(f"{i:06d} "), "file")))
    lines = parts[0]
    for p in parts[1:]:
        lines = lines.unionByName(p)
    order = F.struct("line_key.split", "line_key.pos")
    heads = lines.groupBy("file").agg(F.min_by("line", order).alias("head"), F.min(order).alias("first"))
    heads = heads.select("file", csv_fields(F.col("head")).alias("head"), "first")
    if heads.count() <= HEADER_FILES:
        heads = F.broadcast(heads)
    rows = lines.join(heads, "file").where(order > F.col("first"))
    rows = rows.select("file", "line_key", "line", "head", F.explode(F.array(csv_fields(F.col("line")))).alias("fields"))
    short = F.raise_error(F.concat(F.lit("parameter row shorter than its header: "), F.col("line"))).cast("boolean")
    rows = rows.where(F.when(F.size("fields") >= F.size("head"), True).otherwise(short))
    return rows.select("file", "line_key", F.map_from_arrays("head", F.slice("fields", F.lit(1), F.size("head"))).alias("params"))


# raw text of every top-level "key": value pair of a flat JSON object
_JSON_KEY = r'"((?:[^"\\]|\\.)*)"\s*:\s*(?:\[[^\[\]]*\]|"(?:[^"\\]|\\.)*"|[^,}\s\[{"][^,}\s]*)'
_JSON_VAL = r'"(?:[^"\\]|\\.)*"\s*:\s*(\[[^\[\]]*\]|"(?:[^"\\]|\\.)*"|[^,}\s\[{"][^,}\s]*)'


def raw_json_map(line: Column) -> Column:
    """Flat JSON object -> map<key, raw value text>.

    Values keep the exact text of the line (numbers are never reprinted,
    so ``0.0001`` stays ``0.0001``); lists keep their brackets.
    """
    return F.map_from_arrays(F.regexp_extract_all(line, F.lit(_JSON_KEY), 1),
                             F.regexp_extract_all(line, F.lit(_JSON_VAL), 1))


def read_params_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One parameter set per non-blank line.

    Output: ``line_key`` (file order), ``instance long``, ``params`` map of
    raw value text without ``instance``/``replicates``, ``replicates``
    raw text.  A line without ``instance`` fails the job.
    """
    lines = (spark.read.text(path)
             .select(F.col("value").alias("line"), *line_key_cols())
             .where(F.trim("line") != ""))
    m = raw_json_map(F.col("line"))
    parsed = F.from_json("line", "map<string,string>", {"mode": "FAILFAST"})
    whole = F.size(F.map_keys(m)) == F.size(F.map_keys(parsed))
    bad = F.raise_error(F.concat(F.lit("parameter set that is malformed, nested or without 'instance': "), F.col("line")))
    # a filter, so that a count or a single column is checked as well
    good = F.when(F.element_at(parsed, F.lit("instance")).isNotNull() & whole, True).otherwise(bad.cast("boolean"))
    return lines.where(good).select(
        "file", "line_key", F.element_at(m, F.lit("instance")).cast("long").alias("instance"),
        F.map_filter(m, lambda k, v: ~k.isin("instance", "replicates")).alias("params"),
        F.element_at(m, F.lit("replicates")).alias("replicates"),
    )


def line_key_cols() -> list[Column]:
    """(file, line_key) for a line-mode text scan.

    ``line_key`` = (file, split start, position) orders the lines of one
    file, and the lines of a run whose output is split over several files
    named in order.
    """
    return [F.col("_metadata.file_path").alias("file"),
            F.struct(F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("split"),
                     F.monotonically_increasing_id().alias("pos")).alias("line_key")]


# ---------------------------------------------------------------- S11

def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """Config files -> (file, line_no, raw, prefix, key, eq, val).

    Files are read whole (configs are small) and split into lines with
    their position; a final newline does not add an empty line.  Comment
    and free lines have null key.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return config_lines(files)


def split_lines(text: Column) -> Column:
    """Text -> lines as readlines() sees them (no empty line after a final newline)."""
    body = F.regexp_replace(text, r"\n\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n"))


def parse_config_line(raw: Column) -> list[Column]:
    m = lambda i: F.regexp_extract(raw, CONFIG_LINE, i)
    is_kv = raw.rlike(CONFIG_LINE) & ~raw.startswith("#")
    return [F.when(is_kv, m(1)).alias("prefix"), F.when(is_kv, m(2)).alias("key"),
            F.when(is_kv, m(3)).alias("eq"), F.when(is_kv, m(4)).alias("val")]


def config_lines(files: DataFrame, text_col: str = "text") -> DataFrame:
    lines = files.select("file", F.posexplode(split_lines(F.col(text_col))).alias("line_no", "raw"))
    return lines.select("file", "line_no", "raw", *parse_config_line(F.col("raw")))


# ---------------------------------------------------------------- S12 / S13

def read_stdout(spark: SparkSession, path: str, name_pattern: str = r"[^/]*$") -> DataFrame:
    """Per-run stdout lines with file identity, in file order.

    Output: ``file``, ``name`` (regexp on the path), ``line_key``, ``line``.
    Line mode: a large stdout file is split over many tasks.
    """
    return spark.read.text(path).select(
        *line_key_cols(), F.col("value").alias("line")).select(
        "file", F.regexp_extract("file", name_pattern, 0).alias("name"), "line_key", "line")


#: Ends the tag of a line's run in gathered output.
TAG_END = "\t"


def read_tagged_stdout(spark: SparkSession, path: str) -> DataFrame:
    """S12 for gathered output: ``run`` (the line's tag), ``file``, ``line_key``, ``line``, in file order.

    One file holds the lines of many runs, each behind its run's tag, and a
    run may go on in the next file, so a sweep of many short runs needs few
    files.  A line without a tag fails the job."""
    cut = F.instr("value", TAG_END)
    bad = F.raise_error(F.concat(F.lit("stdout line without a tag: "), F.col("value")))
    run = F.when(cut > 0, F.substring("value", F.lit(1), cut - 1)).otherwise(bad.cast("string"))
    lines = spark.read.text(path).select(*line_key_cols(), run.alias("run"), F.substr("value", cut + 1).alias("line"))
    return lines.select("run", "file", "line_key", "line")


def read_day_table_lines(spark: SparkSession, path: str, run_pattern: str) -> DataFrame:
    """S13 in line mode: ``task_id``, ``line_key``, ``line`` for every line of
    every run's day-table files (run id = first group of ``run_pattern`` on
    the path).  Nothing is read whole, so a run of any size is split over
    many tasks; see ``daytable.explode_day_lines``."""
    return spark.read.text(path).select(
        F.regexp_extract(F.col("_metadata.file_path"), run_pattern, 1).cast("long").alias("task_id"),
        *line_key_cols()[1:], F.col("value").alias("line"))


def read_day_tables(spark: SparkSession, path: str, run_pattern: str) -> DataFrame:
    """Whole ``output.dat`` per run; run id = first group of ``run_pattern`` on the path."""
    return spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), run_pattern, 1).cast("long").alias("task_id"),
        F.col("value").alias("output_dat"))


# ---------------------------------------------------------------- S16

def write_manifest(df: DataFrame, path: str) -> str:
    df.select("fname", "seed", "p_trans").write.mode("overwrite").option("header", "true").csv(path)
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("header", "true").option("mode", "FAILFAST").csv(path)


# ---------------------------------------------------------------- S17

#: Rows of an index (one per run, or run and step) up to which it is broadcast.
INDEX_ROWS = 1_000_000

_SNAPSHOT_DIR = r"seed=([^/]*)/run=([^/]*)/plt=([^/]*)/[^/]*$"


def small_side(index: DataFrame, limit: int = INDEX_ROWS) -> DataFrame:
    """A broadcast hint where a count shows at most ``limit`` rows; else the join is left to the shuffle."""
    return F.broadcast(index) if index.limit(limit + 1).count() <= limit else index


def snapshot_index(spark: SparkSession, root: str, types: StructType | None = None) -> DataFrame:
    """``seed, run, plt, step`` of every step directory, from the file listing alone.

    ``step`` = position of the directory name among the run's sorted ones; a
    directory without data files is none.  Names are text, or of the ``types``
    that a scan gave them."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(root).select("path"))

    def name(i: int, c: str) -> Column:
        part = F.regexp_extract("path", _SNAPSHOT_DIR, i)
        text = F.coalesce(F.try_url_decode(F.regexp_replace(part, r"\+", "%2B")), part)
        return text.cast(types[c].dataType if types is not None else "string").alias(c)

    names = files.select(name(1, "seed"), name(2, "run"), name(3, "plt")).distinct()
    w = Window.partitionBy("seed", "run").orderBy("plt")
    return names.withColumn("step", (F.row_number().over(w) - 1).cast("int"))


def read_snapshots(spark: SparkSession, root: str, schema: StructType | str | None = None,
                   limit: int = INDEX_ROWS) -> DataFrame:
    """Agent snapshots laid out ``<root>/seed=<S>/run=<R>/plt=<step dir>/``.

    Columns first written at a later step read null before.  With ``schema``
    (the fields, without the directory columns) no footer is read to plan;
    without it the schemas of all files are merged.  Steps come from the
    listing (``snapshot_index``, one row per run and step), which is broadcast
    up to ``limit`` rows, so agent rows stay where they are read.
    """
    if schema is None:
        df = spark.read.option("mergeSchema", "true").parquet(root)
    else:
        fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        dirs = StructType.fromDDL("seed string, run string, plt string")
        df = spark.read.schema(StructType(fields.fields + dirs.fields)).parquet(root)
    index = snapshot_index(spark, root, df.schema)
    return df.join(small_side(index, limit), ["seed", "run", "plt"]).drop("plt")


def run_index(spark: SparkSession, root: str) -> DataFrame:
    """``seed, run`` of every run that has a snapshot, from the file listing alone."""
    return snapshot_index(spark, root).select("seed", "run").distinct()
