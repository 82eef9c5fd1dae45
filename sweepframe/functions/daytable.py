"""Day tables (the ``output_dat`` text inside a record) -> long rows.

One record carries a whitespace table: a header line of column names and
one line per simulated day.  ``explode_days`` turns every data line into a
typed row of the fixed long schema.  Column positions are computed once
per record from its header (so a reordered or partial header works), and
the per-line work is split + cast: no Python, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, LongType, StructField, StructType

# The 17 value columns of the long table, in output order,
# named with "/" replaced by "_".
LONG_VALUE_COLUMNS = [
    "Su", "PS_PI", "S_PI_NH", "S_PI_H", "PS_I", "S_I_NH", "S_I_H",
    "A_PI", "A_I", "H_NI", "H_I", "ICU", "V", "R", "D", "NewS", "NewH",
]

LONG_SCHEMA = StructType(
    [StructField("row_id", LongType(), False),
     StructField("params_id", LongType(), False),
     StructField("seed", LongType(), False),
     StructField("Day", IntegerType(), False)]
    + [StructField(c, FloatType(), False) for c in LONG_VALUE_COLUMNS])

# Characters removed at both ends of a line: every code point <= U+0020.
_EDGE_CHARS = "".join(chr(i) for i in range(0x21))


def edge_trim(c: Column) -> Column:
    return F.btrim(c, F.lit(_EDGE_CHARS))


def ws_split(c: Column) -> Column:
    """Split an edge-trimmed line on runs of whitespace.

    Runs are first collapsed to one space by ``regexp_replace`` (its pattern
    is compiled once per task); the split on a single space then takes the
    plain-character path instead of compiling a regex for every row.
    """
    return F.split(F.regexp_replace(c, r"\s+", " "), " ")


def _last_position(reversed_names: Column, n: Column, name: str) -> Column:
    """0-based index of the last occurrence of ``name`` (searched in the reversed header) or null."""
    r = F.array_position(reversed_names, F.lit(name))
    return F.when(r > 0, n - r)


def _header_tokens(first_line: Column) -> Column:
    return F.transform(ws_split(edge_trim(first_line)), lambda x: F.replace(x, F.lit("/"), F.lit("_")))


def _with_positions(df: DataFrame, keep: list[str], carry: list[str]) -> DataFrame:
    """``_hdr`` -> ``_n`` and one ``_p_<col>`` per output column, in a projection
    of its own (evaluated once per header, not per data line)."""
    n = F.size("_hdr")
    rev = F.col("_rhdr")
    positions = [F.coalesce(_last_position(rev, n, "Day"), F.lit(0)).alias("_p_Day")]
    positions += [_last_position(rev, n, c).alias(f"_p_{c}") for c in LONG_VALUE_COLUMNS]
    return df.withColumn("_rhdr", F.reverse("_hdr")).select(
        *keep, "row_id", "params_id", "seed", n.alias("_n"), *positions, *carry)


_POS_COLS = [f"_p_{c}" for c in ["Day"] + LONG_VALUE_COLUMNS]


def _project_lines(lines: DataFrame, keep: list[str], mode: str) -> DataFrame:
    """Data lines (with ``_n``/``_p_*``/``_line``) -> typed long rows."""
    trimmed = lines.select("*", edge_trim(F.col("_line")).alias("_trim")).where(F.col("_trim") != "")
    tok_line = trimmed.select("*", ws_split(F.col("_trim")).alias("_tok")).where(F.size("_tok") >= F.col("_n"))

    def cell(p):
        return F.get(F.col("_tok"), F.col(p))

    if mode == "failfast":
        day = cell("_p_Day").cast("int")
        vals = [F.coalesce(cell(f"_p_{c}").cast("float"), F.lit(0.0).cast("float")).alias(c)
                for c in LONG_VALUE_COLUMNS]
        return tok_line.select(*keep, "row_id", "params_id", "seed", day.alias("Day"), *vals)
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode}")
    day = cell("_p_Day").try_cast("int")
    bad = day.isNull()
    vals = []
    for c in LONG_VALUE_COLUMNS:
        raw = cell(f"_p_{c}")
        v = raw.try_cast("float")
        bad = bad | (raw.isNotNull() & v.isNull())
        vals.append(F.coalesce(v, F.lit(0.0).cast("float")).alias(c))
    return tok_line.select(*keep, "row_id", "params_id", "seed", day.alias("Day"), *vals,
                           bad.alias("_bad"), F.col("_line").alias("_raw_line"))


def _ids() -> list[Column]:
    return [F.coalesce(F.col("task_id"), F.lit(0).cast("long")).alias("row_id"),
            F.coalesce(F.col("params_id"), F.lit(0).cast("long")).alias("params_id"),
            F.coalesce(F.col("seed"), F.lit(0).cast("long")).alias("seed")]


def explode_days(records: DataFrame, mode: str = "failfast", keep: list[str] | None = None) -> DataFrame:
    """R5-R10 on parsed records (``task_id, params_id, seed, output_dat``).

    * header = first line, edge-trimmed, split on whitespace, ``/`` -> ``_``;
      a duplicated name resolves to its last position; ``Day`` falls back
      to position 0
    * blank data lines are skipped; a line with fewer tokens than the
      header is dropped (R8); extra tokens are ignored
    * absent value columns read 0.0 (R7); absent ids read 0 (R10)
    * ``mode="failfast"``: a bad number fails the job (ANSI cast);
      ``mode="quarantine"``: such rows get ``_bad = true`` instead
    """
    keep = keep or []
    lines = F.split(F.col("output_dat"), "\n")
    per_record = records.select(
        *keep, *_ids(), _header_tokens(F.element_at(lines, 1)).alias("_hdr"),
        F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))).alias("_body"),
    ).where(F.col("_hdr").isNotNull())
    per_pos = _with_positions(per_record, keep, ["_body"])
    with_line = per_pos.select(*keep, "row_id", "params_id", "seed", "_n", *_POS_COLS,
                               F.explode("_body").alias("_line"))
    return _project_lines(with_line, keep, mode)


def explode_day_lines(runs: DataFrame, lines: DataFrame, mode: str = "failfast") -> DataFrame:
    """R5-R10 for day tables read line by line (``sources.text.read_day_table_lines``).

    ``runs``: ``task_id, params_id, seed``; ``lines``: ``task_id, line_key, line``.
    The header of a run is its first line (partial ``min_by`` per task, then
    one row per run); header positions are computed per run and joined to
    the lines, so no run's table is ever gathered into one row or task.
    """
    heads = lines.groupBy("task_id").agg(F.min_by("line", "line_key").alias("_first_line"),
                                         F.min("line_key").alias("_first_key"))
    per_run = runs.join(heads, "task_id").select(
        *_ids(), "task_id", "_first_key", _header_tokens(F.col("_first_line")).alias("_hdr"))
    per_pos = _with_positions(per_run, [], ["task_id", "_first_key"])
    body = lines.join(per_pos, "task_id").where(F.col("line_key") != F.col("_first_key"))
    return _project_lines(body.withColumnRenamed("line", "_line"), [], mode)
