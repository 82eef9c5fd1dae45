"""Block-log source/sink: layout, short blocks, pushdown, auto size, stream."""

import os

import pytest
from pyspark.sql import functions as F

from sweepframe.functions.records import parse_records, split_header
from sweepframe.sources.blocklog import detect_block_size

REC = '{\n  "day_final": 2,\n  "task_id": %d,\n  "seed": 0,\n  "output_dat": "Day Su\n0 5\n1 6\n"\n}\n'


def write_raw(path, payloads, block):
    with open(path, "wb") as f:
        for p in payloads:
            b = p.encode("utf-8")
            f.write(b.ljust(block, b"\x00"))


def test_read_blocks_and_short_last_block(spark, tmp):
    p = os.path.join(tmp, "a.log")
    write_raw(p, [REC % 1, REC % 2], 256)
    with open(p, "ab") as f:
        f.write((REC % 3).encode()[:40])  # half-written last block
    df = spark.read.format("blocklog").option("blockSize", "256").load(p)
    rows = df.orderBy("block_idx").collect()
    assert [r.block_idx for r in rows] == [0, 1, 2]
    assert not rows[0].payload.endswith(b"\x00")
    recs = parse_records(df)
    # the truncated object is not a record
    assert sorted(r.task_id for r in recs.collect()) == [1, 2]


def test_sink_roundtrip_and_pushdown(spark, tmp):
    out = os.path.join(tmp, "log")
    src = spark.range(0, 50).select(F.format_string('{"task_id": %d, "output_dat": "Day\\n1\\n"}', "id").alias("value"))
    src.repartition(3).write.format("blocklog").mode("overwrite").option("blockSize", "128").save(out)
    files = [f for f in os.listdir(out) if f.endswith(".log")]
    assert len(files) == 3 and "_SUCCESS" in os.listdir(out)
    assert not [f for f in os.listdir(out) if f.endswith(".tmp")]
    df = spark.read.format("blocklog").option("blockSize", "128").load(out)
    assert df.count() == 50
    assert df.where(F.col("block_idx").isin(0, 1)).count() == 6
    picked = spark.read.format("blocklog").option("blockSize", "128").option("blocks", "0,1").load(out)
    assert picked.count() == 6 and df.count() == 50
    ranged = spark.read.format("blocklog").option("blockSize", "128").option("minBlock", "10").load(out)
    assert ranged.count() == 50 - sum(min(10, n) for n in [r.n for r in df.groupBy("path").agg(F.count("*").alias("n")).collect()])
    got = sorted(r.task_id for r in parse_records(df).collect())
    assert got == list(range(50))


def test_record_too_big_fails(spark, tmp):
    out = os.path.join(tmp, "big")
    src = spark.range(1).select(F.repeat(F.lit("x"), 300).alias("value"))
    with pytest.raises(Exception):
        src.write.format("blocklog").mode("overwrite").option("blockSize", "256").save(out)


def test_multibyte_guard_counts_bytes(spark, tmp):
    out = os.path.join(tmp, "mb")
    # 100 characters but 300 bytes: must not fit a 256-byte block
    src = spark.range(1).select(F.repeat(F.lit("€"), 100).alias("value"))
    with pytest.raises(Exception):
        src.write.format("blocklog").mode("overwrite").option("blockSize", "256").save(out)


def test_auto_block_size(tmp):
    p = os.path.join(tmp, "auto.log")
    write_raw(p, [REC % 1, REC % 2, REC % 3], 512)
    assert detect_block_size(p) == 512
    q = os.path.join(tmp, "one.log")
    write_raw(q, [REC % 1], 300)
    assert detect_block_size(q) == 300


def test_header_split(spark, tmp):
    p = os.path.join(tmp, "h.log")
    write_raw(p, ['{"header": "true", "date": "x", "replicates": 2}', REC % 1], 256)
    recs = parse_records(spark.read.format("blocklog").option("blockSize", "256").load(p))
    hdr, data = split_header(recs)
    meta = hdr.collect()[0].meta
    assert meta == {"date": "x", "replicates": "2"}
    assert [r.task_id for r in data.collect()] == [1]
    # old-style header: no tag, no output_dat
    q = os.path.join(tmp, "h2.log")
    write_raw(q, ['{"date": "y"}', REC % 4], 256)
    recs = parse_records(spark.read.format("blocklog").option("blockSize", "256").load(q))
    hdr, data = split_header(recs)
    assert hdr.count() == 1 and data.count() == 1


def test_stream_consumes_whole_blocks_only(spark, tmp):
    from sweepframe.streaming.tail import append_records

    p = os.path.join(tmp, "s.log")
    write_raw(p, [REC % 1, REC % 2], 256)
    with open(p, "ab") as f:
        f.write((REC % 3).encode()[:30])
    sink, ck = os.path.join(tmp, "sink"), os.path.join(tmp, "ck")
    append_records(spark, p, sink, ck, block_size=256)
    assert sorted(r.task_id for r in spark.read.parquet(sink).collect()) == [1, 2]
    # the writer completes block 2 and appends block 3
    with open(p, "r+b") as f:
        f.seek(512)
        f.write((REC % 3).encode().ljust(256, b"\x00"))
        f.write((REC % 4).encode().ljust(256, b"\x00"))
    append_records(spark, p, sink, ck, block_size=256)
    assert sorted(r.task_id for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]


def test_read_blocks_by_request(spark, tmp):
    from sweepframe.sources.blocklog import read_blocks

    p = os.path.join(tmp, "r.log")
    write_raw(p, [REC % i for i in range(10)], 256)
    req = spark.createDataFrame([(p, 7), (p, 2), (p, 9), (p, 40)], "path string, block_idx long")
    got = parse_records(read_blocks(req, 256)).select("block_idx", "task_id").collect()
    # a block past the end of the file yields nothing
    assert sorted((r.block_idx, r.task_id) for r in got) == [(2, 2), (7, 7), (9, 9)]


def test_partitioned_sink_spreads_keys(spark, tmp):
    from sweepframe.plans.fixtures import write_blocklog

    out = os.path.join(tmp, "pk")
    df = spark.range(0, 40, 1, 4).select(
        F.format_string('{"task_id": %d}', "id").alias("value"), (F.col("id") % 2).alias("k"), F.col("id"))
    write_blocklog(df, out, block_size=128, partition_by="k", order_by=["id"])
    dirs = sorted(d for d in os.listdir(out) if d.startswith("k="))
    assert dirs == ["k=0", "k=1"]
    # every task wrote its own file per key: the hot key is not funnelled into one task
    assert all(len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".log")]) == 4 for d in dirs)
    recs = parse_records(spark.read.format("blocklog").option("blockSize", "128").load(out))
    assert sorted(r.task_id for r in recs.collect()) == list(range(40))


def test_stream_sink_appends_exactly_once(spark, tmp):
    src = os.path.join(tmp, "src.log")
    write_raw(src, [REC % i for i in range(6)], 256)
    out, ck = os.path.join(tmp, "out"), os.path.join(tmp, "ck")

    def run():
        blocks = spark.readStream.format("blocklog").option("blockSize", "256").option("path", src).load()
        q = (blocks.select(F.col("payload").alias("value")).writeStream.format("blocklog")
             .option("blockSize", "256").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        q.awaitTermination()

    run()
    with open(src, "ab") as f:
        for i in range(6, 9):
            f.write((REC % i).encode().ljust(256, b"\x00"))
    run()
    recs = parse_records(spark.read.format("blocklog").option("blockSize", "256").load(out))
    assert sorted(r.task_id for r in recs.collect()) == list(range(9))
    assert all(f.startswith("batch-") for f in os.listdir(out) if f.endswith(".log"))


def test_auto_stride_of_each_file(spark, tmp):
    """Files of different strides, one object, and a second object far behind."""
    d = os.path.join(tmp, "logs")
    os.makedirs(d)
    write_raw(os.path.join(d, "a.log"), [REC % 1], 300)
    write_raw(os.path.join(d, "b.log"), [REC % 2, REC % 3], 512)
    write_raw(os.path.join(d, "c.log"), [REC % 4, REC % 5], 3 << 20)
    got = spark.read.format("blocklog").option("blockSize", "auto").load(d)
    assert sorted(r.task_id for r in parse_records(got).collect()) == [1, 2, 3, 4, 5]
    assert got.count() == 5


def test_packed_files_read_as_plain_ones(spark, tmp, monkeypatch):
    """Compressed frames: every reader finds the blocks of the unpacked content; half a file is not read as a short one."""
    from sweepframe.sources import blocklog as B

    monkeypatch.setattr(B, "FRAME_BYTES", 700)  # several frames a file, here and in the tasks
    src = spark.range(0, 90, 1, 2).select(F.format_string('{"task_id": %d, "output_dat": "Day\\n1\\n"}', "id").alias("value"))
    for kind in ("none", "zstd"):
        (src.write.format("blocklog").mode("overwrite").option("blockSize", "128").option("headerJson", '{"header": "true"}')
         .option("compression", kind).save(f"{tmp}/{kind}"))
    files = B.file_blocks(f"{tmp}/zstd", "listed")
    assert all(p.endswith(B.PACKED) and n == 46 * 128 and os.path.getsize(p) < n / 2 and b == 128 for p, n, b in files)
    assert B.whole_blocks(f"{tmp}/zstd", 128) == B.whole_blocks(f"{tmp}/none", 128) == 92
    assert {b for _, _, b in B.file_blocks(f"{tmp}/zstd", "auto")} == {detect_block_size(f"{tmp}/zstd")} == {128}
    for size in ("128", "auto", "listed"):
        df = spark.read.format("blocklog").option("blockSize", size).option("blocksPerPartition", "7").load(f"{tmp}/zstd")
        _, recs = split_header(parse_records(df))
        assert sorted(r.task_id for r in recs.collect()) == list(range(90))
    for df in (B.scan_blocks(spark, f"{tmp}/zstd", "listed"), B.read_blocks(df.select("path", "block_idx"), 128)):
        assert sorted(r.task_id for r in parse_records(df).where("task_id IS NOT NULL").collect()) == list(range(90))
    picked = spark.read.format("blocklog").option("blockSize", "128").option("blocks", "0,41,45,46").load(f"{tmp}/zstd")
    assert picked.count() == 6
    sizes = spark.createDataFrame([(p, os.path.getsize(p)) for p, _ in B.list_log_files(tmp + "/none") + B.list_log_files(tmp + "/zstd")], "path string, length long")
    assert [r[0] for r in sizes.select(B.unpacked_length(F.col("path"), F.col("length"))).collect()] == [46 * 128] * 4
    with open(files[0][0], "r+b") as f:
        f.truncate(os.path.getsize(files[0][0]) - 5)
    with pytest.raises(Exception, match="not a whole packed file"):
        df = spark.read.format("blocklog").option("blockSize", "128").load(f"{tmp}/zstd").collect()
    with pytest.raises(Exception, match="unknown compression"):
        src.write.format("blocklog").mode("overwrite").option("compression", "lz").save(f"{tmp}/lz")
