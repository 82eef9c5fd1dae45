"""A kept index of a block log, from record ids to the blocks that hold them.

``extend`` reads the blocks that were added since the last time, no others,
and adds their ids as one batch: Parquet files ranged and sorted by id, so a
lookup of few ids reads few row groups.  A batch and the offsets it reaches
become visible together, by one manifest; an attempt that fails leaves
nothing, and the next one starts from the same offsets.  ``lookup`` gives the
blocks of wanted ids, for ``read_blocks``; it never touches the log.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.functions.records import parse_records, split_header
from sweepframe.sources.blocklog import _fs, add_manifest, block_ranges, committed, read_blocks, scan_blocks

#: Ids kept for each record.
IDS = ("task_id", "params_id", "seed")

_ENTRIES = "task_id long, params_id long, seed long, path string, block_idx long"
_OFFSETS = "path string, blocks long, block long"


def _batches(index: str) -> list[str]:
    filesystem, root, _ = _fs(index)
    return [name for m in committed(filesystem, root) or [] for name, *_ in m.files]


def _read(spark: SparkSession, index: str, part: str, schema: str) -> DataFrame:
    paths = [f"{index.rstrip('/')}/{part}/{b}" for b in _batches(index)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def entries(spark: SparkSession, index: str) -> DataFrame:
    """``task_id, params_id, seed, path, block_idx`` of every indexed record."""
    return _read(spark, index, "entries", _ENTRIES)


def offsets(spark: SparkSession, index: str) -> DataFrame:
    """Blocks indexed so far, one row per file of the log."""
    return _read(spark, index, "offsets", _OFFSETS).groupBy("path").agg(F.max("blocks").alias("blocks"))


def extend(spark: SparkSession, log: str, index: str, block_size: int | str = 65536, key: str = "task_id") -> int:
    """Index the whole blocks added since the last call; returns how many there were.

    The log's files are listed on the driver, with one offset each.
    """
    done = {r.path: r.blocks for r in offsets(spark, index).collect()}
    ranges = block_ranges(log, block_size, done, whole=True)
    if not ranges:
        return 0
    _, records = split_header(parse_records(scan_blocks(spark, log, ranges=ranges)))
    batch = uuid.uuid4().hex[:12]
    new = records.select(*IDS, "path", "block_idx")
    new.repartitionByRange(key, "path", "block_idx").sortWithinPartitions(key).write.parquet(f"{index.rstrip('/')}/entries/{batch}")
    reached = spark.createDataFrame([(p, stop, block) for p, _, stop, block in ranges], _OFFSETS)
    reached.coalesce(1).write.parquet(f"{index.rstrip('/')}/offsets/{batch}")
    filesystem, root, _ = _fs(index)
    filesystem.create_dir(posixpath.join(root, "entries"), recursive=True)
    add_manifest(filesystem, root, batch, [[batch, 0, 0]])
    return sum(stop - first for _, first, stop, _ in ranges)


def lookup(spark: SparkSession, index: str, wanted: DataFrame | list, key: str = "task_id") -> DataFrame:
    """``path, block_idx`` of the wanted ids: a short list is pushed into the index's Parquet scan, a table is joined."""
    known = entries(spark, index)
    if isinstance(wanted, DataFrame):
        ids = wanted.select(F.col(key).cast("long").alias(key)).distinct()
        return known.join(ids, key, "left_semi").select("path", "block_idx")
    return known.where(F.col(key).isin([int(i) for i in wanted])).select("path", "block_idx")


def fetch(spark: SparkSession, index: str, wanted: DataFrame | list, block_size: int = 65536, key: str = "task_id") -> DataFrame:
    """The records of the wanted ids, read by seeking to their blocks; ``block_size`` is that of files indexed without one."""
    sizes = _read(spark, index, "offsets", _OFFSETS).groupBy("path").agg(F.max("block").alias("block"))  # a row a file
    return parse_records(read_blocks(lookup(spark, index, wanted, key).join(F.broadcast(sizes), "path", "left"), block_size))
