"""Sweep expansion (G1-G6) and distributed row numbering.

Sweep tables multiply a run table by value tables: a generator writes the
positions, an equi-join on them brings the values (a short value table is
broadcast, the multiplied runs never).  Ids are computed from positions, never from a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# partitions are indexed in the upper bits of monotonically_increasing_id
_PART_SHIFT = 33

#: Values of a sweep parameter up to which their table is broadcast.
VALUE_ROWS = 100_000


def index_rows(df: DataFrame, name: str = "row_no", order_by: list | None = None,
               start: int = 1, checkpoint: bool = True) -> DataFrame:
    """Consecutive row numbers without a single-partition window.

    With ``order_by`` the rows are range-partitioned and sorted (a normal
    distributed sort); without it the current order is kept.  Each
    partition's row count is taken once (a tiny table, one row per
    partition), prefix sums give partition offsets, and every row gets
    ``offset + position in partition``.  The sorted input is checkpointed
    to the shared work folder so both passes see identical rows.
    """
    base = df.sort(*order_by) if order_by else df
    tagged = base.withColumn("_mid", F.monotonically_increasing_id())
    if checkpoint:
        tagged = tagged.checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), _PART_SHIFT)
    counts = tagged.groupBy(part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", "_first",
                            F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = tagged.join(F.broadcast(offsets), part == F.col("_part"))
    return out.withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_first") + start).cast("long")) \
              .drop("_mid", "_part", "_first", "_off")


def index_in_file_order(df: DataFrame, name: str = "row_no", start: int = 1) -> DataFrame:
    """G4 for file scans: number rows in file order (file path, then split, then position).

    ``df`` must carry ``file`` and ``line_key`` (see ``sources.text.line_key_cols``).
    Splits of one file are read in order and their rows get consecutive
    ids, so a table with one row per split gives the offsets.  That table
    grows with the input (one row per 128 MiB), so it is joined normally and
    AQE decides whether to broadcast it.
    """
    chunk = [F.col("file"), F.col("line_key.split")]
    counts = df.groupBy(F.col("file").alias("_f"), F.col("line_key.split").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("line_key.pos").alias("_first"))
    w = Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_f", "_s", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = df.join(offsets, (chunk[0] == F.col("_f")) & (chunk[1] == F.col("_s")))
    return out.withColumn(name, (F.col("_off") + F.col("line_key.pos") - F.col("_first") + start).cast("long")) \
              .drop("_f", "_s", "_first", "_off")


def value_table(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of ``col`` as ``(pos, value)``, ``pos`` from 0.

    A sweep parameter, of any length: numbered like any other rows (G4) and
    joined by position, never gathered into one row.
    """
    vals = df.select(F.col(col).alias("value")).distinct()
    return index_rows(vals, "pos", [F.col("value")], start=0)


def _times(rows: DataFrame, values: DataFrame | Column, pos: str, name: str, n: str) -> DataFrame:
    """Every row with every value, the multiplication that a sweep is: a
    generator writes the positions on each row, an equi-join on the position
    brings the value.  ``n`` is the number of values (a scalar subquery).
    The planner takes the multiplied rows to be as few as the runs and would
    broadcast them, so the join is named: short value tables are broadcast,
    long ones are merged.  A caller's own short list may be an array column, which needs no join."""
    if isinstance(values, Column):
        return rows.select("*", F.posexplode(values).alias(pos, name), F.size(values).alias(n))
    count = values.agg(F.count(F.lit(1))).scalar()
    every = rows.withColumn(n, count).where(F.col(n) > 0)
    every = every.withColumn(pos, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))
    named = values.select(F.col("pos").alias(pos), F.col("value").alias(name))
    if values.limit(VALUE_ROWS + 1).count() <= VALUE_ROWS:
        return every.join(F.broadcast(named), pos)
    return every.hint("merge").join(named, pos)


def spread(rows: DataFrame, per_core: int = 4) -> DataFrame:
    """Rows shared out evenly: a table of few, short rows is one or two tasks
    of a scan, however much work each of its rows becomes."""
    return rows.repartition(per_core * rows.sparkSession.sparkContext.defaultParallelism)


def grid(days: DataFrame, p_trans: DataFrame | Column, compliance: DataFrame | Column) -> DataFrame:
    """G1: day x p_trans x compliance, day outermost.

    ``days`` has ``(day_pos, day)``; the other two are value tables.
    ``sample_id = (d*nP + p)*nC + c``.
    """
    out = _times(days, p_trans, "p_pos", "p_trans", "_np")
    out = _times(out, compliance, "c_pos", "compliance", "_nc")
    sid = (F.col("day_pos") * F.col("_np") + F.col("p_pos")) * F.col("_nc") + F.col("c_pos")
    return out.select(sid.cast("long").alias("sample_id"), "day", "p_trans", "compliance")


def seed_sweep(seeds: DataFrame, choices: DataFrame | Column, stem: str, out_stem: str) -> DataFrame:
    """Seeds (1..S, outer) x value choices (inner, a value table); running
    id from 1 and the derived file names."""
    out = _times(spread(seeds.select("seed")), choices, "pos", "p_trans", "_n")
    i = ((F.col("seed") - 1) * F.col("_n") + F.col("pos") + 1).cast("long")
    return out.select(
        i.alias("i"), "seed", "p_trans",
        F.format_string(f"{stem}_%d.bay", i).alias("fname"),
        F.format_string(f"{out_stem}_%d.dat", i).alias("output_fname"))


def study(samples: DataFrame, seeds: DataFrame | Column) -> DataFrame:
    """Every sample with every global seed (a value table) and its
    ``seed_pos``, which orders the runs with seeds outermost."""
    out = _times(samples, seeds, "seed_pos", "seed", "_n")
    return out.select(*samples.columns, F.col("seed_pos").cast("int").alias("seed_pos"), "seed")


def expand_replicates(params: DataFrame, replicates: int | Column, params_id: str = "params_id") -> DataFrame:
    """Each params row -> R runs, ``seed`` 0..R-1, ``task_id = level*R + seed``.

    ``level`` is the 0-based row position, i.e. ``params_id - 1``.
    No shuffle: a generator on each row; no replicates give no rows.
    """
    r = replicates if isinstance(replicates, Column) else F.lit(int(replicates))
    out = params.withColumn("_r", r.cast("long")).where("_r > 0").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_r") - 1)).alias("seed"))
    level = F.col(params_id) - 1
    return out.withColumn("task_id", level * F.col("_r") + F.col("seed")).drop("_r")


def random_seeds(runs: DataFrame, lo: int = 0, hi: int = 10_000_000, seed: int = 0,
                 name_fmt: str = "seed_%02d_%05d", idx: str = "idx") -> DataFrame:
    """An evenly spread integer seed in [lo, hi] per run: the first 13 hex
    digits of ``md5("<seed>/<idx>")`` modulo the range, so it depends on
    nothing but ``seed`` and the run's index."""
    drawn = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(idx).cast("string")).cast("binary")), 1, 13), 16, 10)
    s = drawn.cast("long") % (hi - lo + 1) + lo
    out = runs.withColumn("seed", s)
    return out.withColumn("name", F.format_string(name_fmt, F.col(idx), F.col("seed")))
