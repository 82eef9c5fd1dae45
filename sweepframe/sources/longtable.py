"""Long table sink and dataset-level header metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.functions.daytable import LONG_SCHEMA

_META_KEY = "sweep_header"


def write_long(df: DataFrame, path: str, header: dict | None = None, v2: bool = False) -> str:
    """S14 + S15: overwrite ``path`` with the fixed long schema (Snappy Parquet).

    Header pairs are stored as metadata of the ``row_id`` field, which Spark
    keeps in the Parquet footer together with the schema, and as a sidecar
    table ``<path>/_header`` (key, value) that readers of the data skip.
    """
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in LONG_SCHEMA.fields])
    if header:
        out = out.withMetadata("row_id", {_META_KEY: json.dumps(header, sort_keys=False)})
    w = out.write.mode("overwrite").option("compression", "snappy")
    if v2:
        w = w.option("parquet.writer.version", "v2")
    w.parquet(path)
    if header:
        spark = df.sparkSession
        pairs = spark.createDataFrame([(str(k), str(v)) for k, v in header.items()], "key string, value string")
        pairs.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/_header")
    return path


def read_header(spark: SparkSession, path: str) -> dict:
    """Header pairs stored by ``write_long`` (schema metadata only, no data read)."""
    md = spark.read.parquet(path).schema["row_id"].metadata
    return json.loads(md[_META_KEY]) if _META_KEY in md else {}


def header_table(spark: SparkSession, path: str) -> DataFrame:
    """The ``_header`` sidecar as a (key, value) table."""
    return spark.read.parquet(f"{path.rstrip('/')}/_header")
