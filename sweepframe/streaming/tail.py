"""Tail of a growing block log as a stream (S2) with incremental results.

``readStream.format("blocklog")`` consumes whole blocks only, so a
half-written last block is picked up by a later micro-batch once it is
complete.  ``max_blocks`` bounds a micro-batch: a backlog of N blocks takes
ceil(N / max_blocks) of them.  Parsed records are appended to a Parquet
table (exactly-once through the checkpoint).  Run counts and durations are
kept in a table of one row per params row, of which a micro-batch rewrites
the buckets it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.functions.records import parse_records, split_header
from sweepframe.sources.blocklog import _fs, add_manifest, manifest_names, read_manifest

#: Buckets of a table of running counts.
BUCKETS = 16


def stream_records(spark: SparkSession, path: str, block_size: int | str = 65536, max_blocks: int = 0,
                   checkpoint: str | None = None) -> DataFrame:
    """The log's records as a stream; a bound on its batches needs the query's ``checkpoint``."""
    blocks = spark.readStream.format("blocklog").option("blockSize", str(block_size)).option("path", path)
    if max_blocks:
        blocks = blocks.option("maxBlocksPerBatch", str(max_blocks)).option("progress", f"{checkpoint.rstrip('/')}/blocklog/progress.json")
    return parse_records(blocks.load())


def _run(writer, checkpoint: str, available_now: bool):
    """Start the query; with ``available_now`` it ends when the log is used up, in as many batches as that takes."""
    handle = writer.option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds" if available_now else "10 seconds").start()
    if available_now:
        try:
            handle.processAllAvailable()
        finally:
            handle.stop()
    return handle


def append_records(spark: SparkSession, path: str, sink: str, checkpoint: str, block_size: int | str = 65536,
                   available_now: bool = True, max_blocks: int = 0):
    """Stream the log's records into a Parquet table; returns the query."""
    _, rec = split_header(stream_records(spark, path, block_size, max_blocks, checkpoint))
    rec = rec.withColumn("ok", F.length("json") > 0).drop("output_dat", "json")
    return _run(rec.writeStream.format("parquet").option("path", sink).outputMode("append"), checkpoint, available_now)


def _versions(sink: str) -> tuple[set[str], dict[int, str]]:
    """Tags of the committed batches, and the folder of each bucket's rows."""
    filesystem, root, _ = _fs(sink)
    names = manifest_names(filesystem, root)
    return {n.split("-", 1)[1].removesuffix(".json") for n in names}, _named(sink, names[-1:])


def _named(sink: str, names: list[str]) -> dict[int, str]:
    """The folder of each bucket by the given manifest, if any."""
    filesystem, root, _ = _fs(sink)
    return {int(bucket): folder for n in names for folder, bucket, _ in read_manifest(filesystem, root, n).files}


def merged_batches(sink: str) -> int:
    """Number of micro-batches that a table of running counts has taken in."""
    return len(_versions(sink)[0])


def merge_counts(spark: SparkSession, delta: DataFrame, sink: str, tag: str) -> None:
    """Add a batch's ``params_id, n_ok, run_time`` to the table, once for each ``tag``.

    The buckets that the batch touches are read, added up and written to new
    folders; one manifest then names the folder of every bucket, so a reader
    sees all of a batch or nothing.  A batch that was committed is skipped,
    one that failed half-way starts anew.
    """
    tags, now = _versions(sink)
    if tag in tags:
        return
    bucket = F.pmod(F.xxhash64("params_id"), F.lit(BUCKETS)).cast("int")
    delta = delta.select("params_id", "n_ok", "run_time", bucket.alias("bucket"))
    touched = sorted(r.bucket for r in delta.select("bucket").distinct().collect())  # at most BUCKETS
    if not touched:
        return
    folders = [f"{sink.rstrip('/')}/{now[b]}" for b in touched if b in now]
    if folders:
        old = spark.read.schema("params_id long, n_ok long, run_time double").parquet(*folders)
        delta = delta.unionByName(old.select("params_id", "n_ok", "run_time", bucket.alias("bucket")))
    rows = delta.groupBy("bucket", "params_id").agg(F.sum("n_ok").alias("n_ok"), F.sum("run_time").alias("run_time"))
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{sink.rstrip('/')}/{tag}")
    filesystem, root, _ = _fs(sink)
    after = now | {b: f"{tag}/bucket={b}" for b in touched}
    add_manifest(filesystem, root, tag, [[folder, b, 0] for b, folder in sorted(after.items())])
    # readers may still use the version before this one; older ones go
    for b, folder in _named(sink, manifest_names(filesystem, root)[-3:-2]).items():
        if folder not in (now.get(b), after.get(b)) and filesystem.get_file_info(f"{root}/{folder}").type.value:
            filesystem.delete_dir(f"{root}/{folder}")


def running_counts(spark: SparkSession, path: str, sink: str, checkpoint: str, block_size: int | str = 65536, max_blocks: int = 0):
    """R18/R13 over the stream: per params row, successes and total run time, in a table of that many rows."""
    _, rec = split_header(stream_records(spark, path, block_size, max_blocks, checkpoint))

    def merge(batch: DataFrame, batch_id: int):
        delta = batch.groupBy("params_id").agg(F.count_if(F.length("json") > 0).alias("n_ok"),
                                               F.sum(F.col("stop") - F.col("start")).alias("run_time"))
        merge_counts(batch.sparkSession, delta, sink, f"batch-{batch_id:08d}")

    return _run(rec.writeStream.foreachBatch(merge), checkpoint, True)


def latest_counts(spark: SparkSession, sink: str) -> DataFrame:
    """The table of running counts: ``params_id, n_ok, run_time``."""
    _, now = _versions(sink)
    schema = "params_id long, n_ok long, run_time double"
    folders = [f"{sink.rstrip('/')}/{f}" for f in now.values()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
