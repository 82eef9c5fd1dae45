"""Result extraction from run output (R1-R3) and the user scrape hook."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scrape_days(stdout: DataFrame, run: str = "task_id") -> DataFrame:
    """``[Day N ...`` lines -> (run, line_key, day, infected, dead).

    Split on single spaces: item 1 = day, item 5 minus its last character
    = infected, item 7 = dead.
    """
    tok = F.split(F.col("line"), " ")
    return (stdout.where(F.col("line").startswith("[Day "))
            .select(run, "line_key",
                    F.get(tok, 1).cast("long").alias("day"),
                    F.expr("substring(get(split(line, ' '), 5), 1, length(get(split(line, ' '), 5)) - 1)")
                    .cast("long").alias("infected"),
                    F.get(tok, 7).cast("long").alias("dead")))


def collect_series(days: DataFrame, runs: DataFrame, run: str = "task_id") -> DataFrame:
    """R2: per run, ``infected``/``deaths`` in line order and ``day_final``
    (day of the last day line, 0 when there is none).

    One row per run: the per-run arrays are bounded by the days simulated.
    Partial aggregation does not apply to ordered collects, so the day
    rows shuffle once on the run id.
    """
    s = days.groupBy(run).agg(
        F.sort_array(F.collect_list(F.struct("line_key", "day", "infected", "dead"))).alias("_s"))
    s = s.select(run,
                 F.element_at("_s", -1)["day"].alias("day_final"),
                 F.transform("_s", lambda x: x["infected"]).alias("infected"),
                 F.transform("_s", lambda x: x["dead"]).alias("deaths"))
    out = runs.join(s, run, "left")
    return out.select(
        *[c for c in runs.columns],
        F.coalesce("day_final", F.lit(0).cast("long")).alias("day_final"),
        F.coalesce("infected", F.array().cast("array<bigint>")).alias("infected"),
        F.coalesce("deaths", F.array().cast("array<bigint>")).alias("deaths"))


def series_from_stdout(stdout: DataFrame, run: str = "task_id") -> DataFrame:
    """R1 + R2 in one pass: every run present in ``stdout`` gets its series;
    a run without day lines gets empty arrays and ``day_final = 0``.

    Non-day lines contribute nothing to the (partially aggregated) collect,
    so there is no second scan for the list of runs and no join.
    """
    tok = F.split(F.col("line"), " ")
    is_day = F.col("line").startswith("[Day ")
    day = F.struct(
        F.col("line_key").alias("line_key"), F.get(tok, 1).cast("long").alias("day"),
        F.expr("substring(get(split(line, ' '), 5), 1, length(get(split(line, ' '), 5)) - 1)")
        .cast("long").alias("infected"),
        F.get(tok, 7).cast("long").alias("dead"))
    s = stdout.groupBy(run).agg(F.sort_array(F.collect_list(F.when(is_day, day))).alias("_s"))
    return s.select(
        run,
        F.coalesce(F.try_element_at("_s", F.lit(-1))["day"], F.lit(0).cast("long")).alias("day_final"),
        F.transform("_s", lambda x: x["infected"]).alias("infected"),
        F.transform("_s", lambda x: x["dead"]).alias("deaths"))


def assemble(series: DataFrame, day_tables: DataFrame, run: str = "task_id",
             with_params_id: bool = True) -> DataFrame:
    """A result record per run: series + ``output_dat`` + ids/seed/start/stop.

    ``series`` already carries the run columns (``cfg_id``, ``seed``,
    ``start``, ``stop`` and optionally ``params_id``); ``params_id`` is
    cast to an integer and left out when not supplied.
    """
    rec = series.join(day_tables, run, "left")
    cols = ["day_final", "infected", "deaths", "output_dat", run, "cfg_id"]
    if with_params_id and "params_id" in rec.columns:
        rec = rec.withColumn("params_id", F.col("params_id").cast("long"))
        cols.append("params_id")
    return rec.select(*cols, "seed", "start", "stop")


def with_scrape(df: DataFrame, fn: Callable[[dict], dict], schema: StructType | str,
                inputs: list[str]) -> DataFrame:
    """Run a user function per row and merge its fields into the row.

    ``fn`` receives a dict of ``inputs`` and returns a dict of extra fields
    (``schema``; missing ones are null).  It gets Arrow batches of the inputs
    alone, as exact Python values, on the rows' own partitions; all other
    columns stay in the JVM.  An input may be a path, e.g. the run's folder.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    extra = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    names = [f.name for f in extra.fields]
    clash = [n for n in names if n in df.columns]
    if clash:
        raise ValueError(f"scrape fields already present: {clash}")
    kind = to_arrow_type(extra)

    @F.arrow_udf(returnType=extra)
    def run(*columns: pa.Array) -> pa.Array:
        rows = [fn(dict(zip(inputs, vals))) or {} for vals in zip(*[c.to_pylist() for c in columns])]
        return pa.array([{n: r.get(n) for n in names} for r in rows], kind)

    found = next(c for c in ("_scraped", "_scraped_") if c not in df.columns)
    return df.withColumn(found, run(*inputs)).select(*df.columns, *[F.col(found)[n].alias(n) for n in names])
