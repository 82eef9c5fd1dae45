"""Log to long table and its validation, as single Spark jobs.

``log_to_long`` is the conversion command: scan the block log, split the
header off, explode every record's day table and write the long table
with the header as metadata.  Records read and rows written (R11) are
counted with ``Observation`` while the write runs, so there is no second
pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sweepframe.functions.daytable import LONG_SCHEMA, explode_days
from sweepframe.functions.records import header_pairs, parse_records, split_header
from sweepframe.operators.validate import validate
from sweepframe.sources.blocklog import whole_blocks
from sweepframe.sources.longtable import write_long


def read_log(spark: SparkSession, log_path: str, block_size: int | str = 65536, blocks: str | None = None) -> DataFrame:
    r = (spark.read.format("blocklog").option("blockSize", str(block_size))
         .option("minPartitions", str(spark.sparkContext.defaultParallelism)))
    return (r.option("blocks", blocks) if blocks else r).load(log_path)


def log_records(spark: SparkSession, log_path: str, block_size: int | str = 65536):
    """(header, data records) of a log; the headers are read from block 0 of each file alone."""
    header, _ = split_header(parse_records(read_log(spark, log_path, block_size, "0")))
    _, data = split_header(parse_records(read_log(spark, log_path, block_size)))
    return header, data


def log_to_long(spark: SparkSession, log_path: str, out_path: str, block_size: int | str = 65536,
                mode: str = "failfast", rejects_path: str | None = None) -> dict:
    """Convert a log; returns {records, rows, rejects, expected_blocks, header}.

    ``block_size`` may be ``auto`` (each file's own stride).  With
    ``mode="quarantine"`` lines with a cell that is no number are left out
    of the table and written, with their text, to ``rejects_path``
    (default: beside the table).  The first log's header becomes the table's
    metadata; all logs' headers are kept in the table's ``_headers`` folder.
    """
    header, data = log_records(spark, log_path, block_size)
    first = header.orderBy("path").select("meta").first()  # a header block: one small map
    meta = dict(first["meta"]) if first else None
    rec_obs, row_obs = Observation("records"), Observation("rows")
    recs = data.observe(rec_obs, F.count(F.lit(1)).alias("records"))
    rows, rejects = explode_days(recs, mode), 0
    if mode == "quarantine":
        reject_obs = Observation("rejects")
        bad = explode_days(data, mode).where("_bad").select("row_id", "params_id", "seed", F.col("_raw_line").alias("line"))
        bad.observe(reject_obs, F.count(F.lit(1)).alias("rejects")).write.mode("overwrite").parquet(
            rejects_path or f"{out_path.rstrip('/')}_rejects")
        rows, rejects = rows.where("NOT _bad").drop("_bad", "_raw_line"), reject_obs.get["rejects"]
    write_long(rows.observe(row_obs, F.count(F.lit(1)).alias("rows")), out_path, header=meta)
    header_pairs(header).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/_headers")
    return {"records": rec_obs.get["records"], "rows": row_obs.get["rows"], "rejects": rejects,
            "expected_blocks": whole_blocks(log_path, block_size), "header": meta or {}}


def validate_log(spark: SparkSession, long_path: str, log_path: str, block_size: int | str = 65536,
                 reference_schema=LONG_SCHEMA) -> DataFrame:
    """V1-V5 of a long table against the log it came from."""
    _, data = log_records(spark, log_path, block_size)
    return validate(spark, long_path, data, reference_schema)
