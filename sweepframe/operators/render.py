"""Config rendering (G7-G17): one config text per run, as a DataFrame job.

A template is a small config file.  It is turned into ONE value holding
its parsed lines (``template_row``), inlined into the run table as a
scalar subquery, so every run renders with array ``transform``/``filter`` expressions on
its own row: no shuffle, no Python.  Parameter values travel as raw text
(never reprinted as numbers, never evaluated).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sweepframe.functions.numbers import number_text, reprinted, value_text
from sweepframe.sources.text import CONFIG_LINE

# Keys whose list value is written twice, and the keys the
# sweep form always rewrites from its arguments.
DOUBLED_KEYS = ["disease.hospitalization_days_alpha", "disease.hospitalization_days_beta"]
SEED_KEY = "agent.seed"
URBANPOP_KEY = "agent.urbanpop_filename"
CASES_KEY = "disease.case_filename"
OUTPUT_KEY = "diag.output_filename"
ID_KEY = "id"


# ---------------------------------------------------------------- helpers

# Whitespace as the text tools of the reference see it (every code point
# Python's str.isspace() accepts), built by rule.
_WS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_ws(c: Column) -> Column:
    """``str.strip()``: remove whitespace at both ends."""
    return F.btrim(c, F.lit(_WS))


def _one_template(rows: DataFrame) -> Column:
    """The template's line array as a scalar subquery: computed once, inlined
    into every run row (exactly one template file is required)."""
    return rows.select("tmpl").scalar()


def template_row(lines: DataFrame, lstrip_space: bool = False) -> DataFrame:
    """Config lines (``file, line_no, raw``) -> one row per file with
    ``tmpl array<struct<n, raw, prefix, key, eq, val>>`` in line order."""
    raw = F.col("raw")
    if lstrip_space:  # stripping a line of spaces takes its newline too: the line goes
        lines = lines.where(~(raw.startswith(" ") & (strip_ws(raw) == "")))
        raw = F.when(raw.startswith(" "), F.regexp_replace(raw, r"^\s+", "")).otherwise(raw)
    m = lambda i: F.regexp_extract(raw, CONFIG_LINE, i)
    kv = raw.rlike(CONFIG_LINE)
    line = F.struct(F.col("line_no").alias("n"), raw.alias("raw"),
                    F.when(kv, m(1)).alias("prefix"), F.when(kv, m(2)).alias("key"),
                    F.when(kv, m(3)).alias("eq"), F.when(kv, m(4)).alias("val"))
    return lines.groupBy("file").agg(F.sort_array(F.collect_list(line)).alias("tmpl"))


def format_list_text(v: Column) -> Column:
    """G13 (JSON/Python list text): ``[a, b]`` -> ``a b``; scalars unchanged."""
    items = F.transform(F.split(F.regexp_replace(v, r"^\[|\]$", ""), ","), lambda x: F.trim(x))
    return F.when(v.startswith("["), F.array_join(items, " ")).otherwise(v)


def format_json_value(v: Column) -> Column:
    """G13 for raw JSON value text, as parsing and printing it gives: lists
    joined by spaces, strings unescaped, numbers in their shortest text,
    literals spelled as Python prints them."""
    def one(x: Column) -> Column:
        text = F.get_json_object(F.concat(F.lit('{"v":'), x, F.lit("}")), "$.v")
        return (F.when(x.startswith('"'), text).when(x == "true", F.lit("True")).when(x == "false", F.lit("False"))
                .when(x == "null", F.lit("None")).otherwise(reprinted(x)))

    inside = F.regexp_replace(v, r"^\[\s*|\s*\]$", "")
    items = F.regexp_extract_all(inside, F.lit(r'("(?:[^"\\]|\\.)*"|[^,\s]+)'), 1)
    return F.when(v.startswith("["), F.array_join(F.transform(items, one), " ")).otherwise(one(v))


def format_csv_value(v: Column) -> Column:
    """G13 (CSV form): commas -> spaces, brackets removed (``, `` gives two spaces)."""
    return F.translate(F.coalesce(v, F.lit("None")), ",[]", " ")


def double_list(formatted: Column) -> Column:
    """The space-separated list written twice."""
    return F.concat_ws(" ", formatted, formatted)


def double_value(v: Column) -> Column:
    """G14, sweep form: a list value is repeated; a plain number is added to
    itself (the sweep form reads the value as a number, so ``1.38`` becomes
    ``2.76`` and ``3`` becomes ``6``).  Text is parsed, never evaluated."""
    as_int = v.try_cast("bigint")
    as_dbl = v.try_cast("double")
    return (F.when(F.trim(v).startswith("["), double_list(format_list_text(F.trim(v))))
            .when(as_int.isNotNull(), (as_int * 2).cast("string"))
            .when(as_dbl.isNotNull(), number_text(as_dbl * 2))
            .otherwise(double_list(v)))


def path_join(left: Column, right: Column) -> Column:
    """``os.path.join`` of two parts: an absolute right side wins."""
    return (F.when(right.startswith("/"), right)
            .when((left == "") | left.endswith("/"), F.concat(left, right))
            .otherwise(F.concat(left, F.lit("/"), right)))


def basename(p: Column) -> Column:
    return F.regexp_extract(p, r"[^/]*$", 0)


def extension(p: Column) -> Column:
    """``os.path.splitext`` extension of the base name: from the last dot, if
    some non-dot character comes before it (leading dots do not count)."""
    return F.regexp_extract(basename(p), r"^\.*[^.].*(\.[^.]*)$", 1)


def config_id(tmpl: Column) -> Column:
    """Last ``id`` value of the template, or null."""
    ids = F.filter(tmpl, lambda t: t["key"] == ID_KEY)
    return F.when(F.size(ids) > 0, F.element_at(ids, -1)["val"])


def _kv(t, value: Column) -> Column:
    return F.concat(t["prefix"], t["key"], t["eq"], value)


def _commented(t) -> Column:
    return F.concat(F.lit("# "), t["prefix"], t["key"], t["eq"], t["val"])


def _text(lines: Column) -> Column:
    return F.concat(F.array_join(lines, "\n"), F.lit("\n"))


# ---------------------------------------------------------------- G7

def render_edit(runs: DataFrame, template: DataFrame, *, seed: str = "seed", params: str = "params",
                run_dir: str = "run_dir", urbanpop: str = "urbanpop", cases: str = "cases",
                input_dir: str = "input_dir") -> DataFrame:
    """G7 sweep form.  ``runs`` has the named columns; ``params`` is
    map<string,string> in parameter order.  Adds ``cfg_id`` and ``config``."""
    df = runs.withColumn("tmpl", _one_template(template_row(template, lstrip_space=True)))
    p = F.col(params)
    special = [ID_KEY, SEED_KEY, URBANPOP_KEY, CASES_KEY, OUTPUT_KEY]

    def one(t):
        k = t["key"]
        is_comment = t["raw"].startswith("#")
        in_params = F.coalesce(F.map_contains_key(p, k), F.lit(False))
        new_val = F.element_at(p, k)
        formatted = F.when(k.isin(*DOUBLED_KEYS), double_value(new_val)).otherwise(new_val)
        return (F.when(is_comment | k.isNull(), F.array(t["raw"]))
                .when(k == ID_KEY, F.array().cast("array<string>"))
                .when(k == SEED_KEY, F.array(_commented(t), _kv(t, F.col(seed).cast("string"))))
                .when(k == URBANPOP_KEY, F.array(_commented(t), _kv(t, path_join(F.col(input_dir), F.col(urbanpop)))))
                .when(k == CASES_KEY, F.array(_commented(t), _kv(t, path_join(F.col(input_dir), F.col(cases)))))
                .when(k == OUTPUT_KEY, F.array(_commented(t), _kv(t, path_join(F.col(run_dir), basename(t["val"])))))
                .when(in_params, F.array(F.concat(F.lit("# "), t["raw"]), _kv(t, formatted)))
                .otherwise(F.array(t["raw"])))

    body = F.flatten(F.transform("tmpl", one))
    applied = F.transform(F.filter("tmpl", lambda t: ~t["raw"].startswith("#") & t["key"].isNotNull()
                                   & ~t["key"].isin(*special)), lambda t: t["key"])
    extra = F.transform(F.filter(F.map_keys(p), lambda k: ~F.array_contains(applied, k)),
                        lambda k: F.concat(k, F.lit(" = "), F.element_at(p, k)))
    return df.withColumn("cfg_id", config_id(F.col("tmpl"))) \
             .withColumn("config", _text(F.concat(body, extra))).drop("tmpl")


# ---------------------------------------------------------------- G8

def render_json(params: DataFrame, template: DataFrame, cfg_stem: str, output_dir: str) -> DataFrame:
    """G8 JSON form.  ``params`` = ``read_params_jsonl`` output
    (``instance``, ``params`` map of raw JSON text).  Adds ``name`` and ``config``."""
    df = params.withColumn("tmpl", _one_template(template_row(template)))
    inst = F.col("instance").cast("string")
    frag = F.map_concat(F.col("params"), F.create_map(F.lit(SEED_KEY), inst))
    stem = F.concat(F.lit(cfg_stem + "_"), inst)

    def one(t):
        k = t["key"]
        hit = F.coalesce(F.map_contains_key(frag, k), F.lit(False))
        return (F.when(k == OUTPUT_KEY, F.array(
                    _commented(t), _kv(t, path_join(F.lit(output_dir), F.concat(stem, extension(t["val"]))))))
                .when(k.isNotNull() & hit, F.array(F.concat(F.lit("# "), t["raw"])))
                .otherwise(F.array(t["raw"])))

    body = F.concat(F.array(F.concat(F.lit("instance = "), inst)), F.flatten(F.transform("tmpl", one)))
    commented = F.filter("tmpl", lambda t: t["key"].isNotNull() & (t["key"] != OUTPUT_KEY)
                         & F.coalesce(F.map_contains_key(frag, t["key"]), F.lit(False)))

    def tail_line(t):
        v = format_json_value(F.element_at(frag, t["key"]))
        v = F.when(t["key"].isin(*DOUBLED_KEYS), double_list(v)).otherwise(v)
        return F.concat(t["key"], F.lit(" = "), v)

    tail = F.transform(commented, tail_line)
    gap = F.when((F.size(commented) > 0) & (strip_ws(F.element_at(body, -1)) != ""),
                 F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return df.select("*", F.concat(stem, F.lit(".cfg")).alias("name"),
                     _text(F.concat(body, gap, tail)).alias("config")).drop("tmpl")


# ---------------------------------------------------------------- G9

def render_csv(rows: DataFrame, template: DataFrame, cfg_stem: str, output_dir: str,
               no_comments: bool = False, row_id: str = "row_id", params: str = "params") -> DataFrame:
    """G9 CSV form.  ``rows`` has ``row_id`` (continuing over files, see
    ``sweep.index_in_file_order``) and ``params`` map<string,string>."""
    df = rows.withColumn("tmpl", _one_template(template_row(template)))
    rid = F.col(row_id).cast("string")
    stem = F.concat(F.lit(cfg_stem + "_"), rid)
    p = F.col(params)
    empty = F.array().cast("array<string>")

    def one(t):
        k = t["key"]
        hit = F.coalesce(F.map_contains_key(p, k), F.lit(False))
        v = format_csv_value(F.element_at(p, k))
        v = F.when(k.isin(*DOUBLED_KEYS), F.concat(v, F.lit(" "), v)).otherwise(v)
        comment = empty if no_comments else F.array(_commented(t))
        keep_old = empty if no_comments else F.array(F.concat(F.lit("# "), t["raw"]))
        plain = (F.when(strip_ws(t["raw"]).startswith("#"), empty).otherwise(F.array(t["raw"]))
                 if no_comments else F.array(t["raw"]))
        return (F.when(k == OUTPUT_KEY, F.concat(comment, F.array(
                    _kv(t, path_join(F.lit(output_dir), F.concat(stem, extension(t["val"])))))))
                .when(k.isNotNull() & hit, F.concat(keep_old, F.array(_kv(t, v))))
                .otherwise(plain))

    body = F.concat(F.array(F.concat(F.lit("id = "), rid)), F.flatten(F.transform("tmpl", one)))
    return df.select("*", F.concat(stem, F.lit(".cfg")).alias("name"), _text(body).alias("config")).drop("tmpl")


# ---------------------------------------------------------------- G10

# Fixed value: the fill-in template of the grid study (holes: seed,
# compliance, shelter day, transmission probability).
FILL_TEMPLATE = """agent.max_grid_size = 16
agent.ic_type = "census"
agent.census_filename = "./BayArea.dat"
agent.workerflow_filename = "./BayArea-wf.bin"
agent.case_filename = "./July4.cases"

agent.nsteps = 180
agent.seed = %d
agent.plot_int = 1
agent.random_travel_int = 1
agent.aggregated_diag_int = -1
agent.aggregated_diag_prefix = "cases"
agent.initial_case_type = "random"
agent.num_initial_cases = 10
agent.shelter_compliance = %s
agent.shelter_start = %d
agent.shelter_length = 30
agent.mean_immune_time = 180
agent.immune_time_spread = 60
agent.symptomatic_withdraw = 1
agent.symptomatic_withdraw_compliance = 0.90

contact.pSC = 0.2
contact.pCO = 1.45
contact.pNH = 1.45
contact.pWO = 0.5
contact.pFA = 1.0
contact.pBAR = -1.

disease.nstrain = 1
disease.p_trans = %s
disease.p_asymp = 0.20
disease.reduced_inf = 0.75
disease.symptomdev_length_mean = 3.0
"""


def render_fill(grid: DataFrame, seed: str = "seed", compliance: str = "compliance",
                shelter_day: str = "day", trans: str = "p_trans") -> DataFrame:
    """Fixed text with four holes; seed and shelter day truncated to int.
    ``compliance``/``trans`` are value text (strings) or numbers."""
    kinds = dict(grid.dtypes)
    return grid.withColumn("config", F.format_string(
        FILL_TEMPLATE, F.col(seed).cast("double").cast("long"), value_text(F.col(compliance), kinds[compliance]),
        F.col(shelter_day).cast("double").cast("long"), value_text(F.col(trans), kinds[trans])))


# ---------------------------------------------------------------- G11 / G17

def render_append(sweep: DataFrame, template: DataFrame, fixed_lines: list[str],
                  excluded: list[str], seed: str = "seed", p_trans: str = "p_trans",
                  output_fname: str = "output_fname") -> DataFrame:
    """Keep the template's non-comment ``k=v`` lines whose key is not
    excluded, prefix fixed lines, append the swept lines."""
    lines = template.where(F.instr("raw", "=") > 0).where(~F.col("raw").startswith("#"))
    lines = lines.where(~strip_ws(F.substring_index("raw", "=", 1)).isin(*excluded))
    kept = lines.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("line_no", "raw"))).alias("t")) \
                .select(F.transform("t", lambda x: x["raw"]).alias("kept"))
    df = sweep.withColumn("kept", kept.scalar())
    tail = F.array(F.concat(F.lit("agent.seed = "), F.col(seed).cast("string")),
                   F.concat(F.lit("disease.p_trans = "), value_text(F.col(p_trans), dict(sweep.dtypes)[p_trans])),
                   F.concat(F.lit("diag.output_filename = "), F.col(output_fname)))
    fixed = F.array(*[F.lit(x) for x in fixed_lines]).cast("array<string>")
    return df.withColumn("config", _text(F.concat(fixed, F.col("kept"), tail))).drop("kept")


def rebase_paths(configs: DataFrame, old_root: str, new_root: str, text: str = "config") -> DataFrame:
    """Re-root every data path of rendered configs."""
    return configs.withColumn(text, F.replace(F.col(text), F.lit(old_root), F.lit(new_root)))


# ---------------------------------------------------------------- G12

def render_delete(runs: DataFrame, template: DataFrame, patterns: tuple[str, ...] = (SEED_KEY, OUTPUT_KEY),
                  name: str = "name", seed: str = "seed", stamp: str = "stamp") -> DataFrame:
    """Comment header, template minus lines matching any pattern
    (regex, anywhere in the line), then the new seed and output name."""
    cond = None
    for pat in patterns:
        c = F.col("raw").rlike(pat)
        cond = c if cond is None else (cond | c)
    kept = template.where(~cond).groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct("line_no", "raw"))).alias("t")) \
        .select(F.transform("t", lambda x: x["raw"]).alias("kept"))
    df = runs.withColumn("kept", kept.scalar())
    head = F.array(F.concat(F.lit("# "), F.col(name), F.lit(" generated "), F.col(stamp)), F.lit(""))
    tail = F.array(F.concat(F.lit("agent.seed = "), F.col(seed).cast("string")),
                   F.concat(F.lit("diag.output_filename = "), F.col(name), F.lit(".dat")))
    return df.withColumn("config", _text(F.concat(head, F.col("kept"), tail))).drop("kept")
