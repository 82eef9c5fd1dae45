"""Result records: tolerant JSON parse (S5), header handling (S6, S8), JSON encode.

All of these are column expressions or narrow DataFrame transforms: they
run inside whole-stage codegen and never shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

# Fields of a result record.  Ids are read as text and converted by
# ``_as_long`` so a fractional id is truncated instead of turning null.
RECORD_FIELDS = StructType([
    StructField("task_id", StringType()),
    StructField("params_id", StringType()),
    StructField("cfg_id", StringType()),
    StructField("seed", StringType()),
    StructField("day_final", StringType()),
    StructField("infected", ArrayType(LongType())),
    StructField("deaths", ArrayType(LongType())),
    StructField("start", DoubleType()),
    StructField("stop", DoubleType()),
    StructField("output_dat", StringType()),
    StructField("header", StringType()),
    StructField("_corrupt", StringType()),
])

JSON_OPTIONS = {
    "allowUnquotedControlChars": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
}

_MAP = MapType(StringType(), StringType())


def _as_long(c: Column) -> Column:
    """Text id -> long; fractional values truncate, absent stays null."""
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def block_text(payload: Column) -> Column:
    """Block bytes -> text starting at the first ``{`` (padding/junk before it dropped)."""
    txt = F.decode(payload, "UTF-8")
    return F.regexp_replace(txt, r"^[^{]*", "")


def parse_records(blocks: DataFrame, payload: str = "payload", extra_fields=None) -> DataFrame:
    """One parsed record per block that holds a JSON object.

    Literal newline/CR/tab inside strings are accepted.  A block with no
    object, or a truncated/invalid one, yields nothing (it is not counted).
    Output keeps every input column except the payload, plus the record
    fields, ``json`` (the object text) and ``has_output_dat``.
    """
    schema = RECORD_FIELDS
    if extra_fields:
        schema = StructType(RECORD_FIELDS.fields[:-1] + list(extra_fields) + [RECORD_FIELDS["_corrupt"]])
    keep = [c for c in blocks.columns if c != payload]
    # Generators, so that a filter is not merged into the parse: text and
    # object are made once per block.
    text = blocks.select(*keep, F.inline(F.array(F.struct(block_text(F.col(payload)).alias("json")))))
    parsed = text.where(F.col("json").startswith("{")).select(
        *keep, "json", F.inline(F.array(F.from_json("json", schema, JSON_OPTIONS))))
    fields = [f.name for f in schema.fields if f.name != "_corrupt"]
    out = parsed.where(F.col("_corrupt").isNull()).select(*keep, "json", *fields)
    for idc in ("task_id", "params_id", "seed", "day_final"):
        out = out.withColumn(idc, _as_long(F.col(idc)))
    # `output_dat` present as a key (even as an empty string) marks a result record
    return out.withColumn("has_output_dat", F.col("output_dat").isNotNull())


def header_map(json_col: Column) -> Column:
    """Whole object as map<string,string> (header blocks are flat)."""
    return F.from_json(json_col, _MAP, {"allowUnquotedControlChars": "true"})


def split_header(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(header, data).  Only block 0 of a file can be a header: it is one
    if it has key ``header`` or lacks ``output_dat``.

    header: ``path, meta map<string,string>`` (``header`` key removed)
    data:   the remaining records
    """
    m = header_map(F.col("json"))
    is_hdr = (F.col("block_idx") == 0) & (
        F.map_contains_key(m, "header") | ~F.coalesce(F.map_contains_key(m, "output_dat"), F.lit(False)))
    flagged = records.withColumn("_is_header", F.coalesce(is_hdr, F.lit(False)))
    header = flagged.where("_is_header").select(
        "path", F.map_filter(m, lambda k, v: k != "header").alias("meta"))
    data = flagged.where(~F.col("_is_header")).drop("_is_header")
    return header, data


def header_pairs(header: DataFrame) -> DataFrame:
    """Header maps -> (path, key, value) rows."""
    return header.select("path", F.explode("meta").alias("key", "value"))


def header_record(env: Column, kvs: Column, strict: bool = True) -> Column:
    """Map built from named environment values plus a ``k=v,k=v`` string.

    ``env`` is a map<string,string> column (values already looked up),
    ``kvs`` the pair string.  With ``strict`` (parity) a value stops at a
    second ``=``; otherwise the full text after the first ``=`` is kept.
    Later keys override earlier ones.
    """
    pairs = F.split(kvs, ",")
    keys = F.transform(pairs, lambda p: F.split(p, "=")[0])
    if strict:
        vals = F.transform(pairs, lambda p: F.get(F.split(p, "="), 1))
    else:
        vals = F.transform(pairs, lambda p: F.get(F.split(p, "=", 2), 1))
    kv = F.map_from_arrays(keys, vals)
    return F.map_concat(env, kv)


def to_record_json(df: DataFrame, cols: list[str] | None = None) -> Column:
    """Record as JSON text.  Null fields are written (``cfg_id: null``);
    to leave ``params_id`` out when it was not supplied, drop the column."""
    cols = cols or df.columns
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
