"""Growing logs: commits by manifest, filters on one scan, the kept index, bounded micro-batches, running counts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sweepframe.functions.records import parse_records
from sweepframe.sources import blockindex
from sweepframe.sources import blocklog as B
from sweepframe.streaming import tail

REC = '{"day_final": 2, "task_id": %d, "params_id": %d, "seed": 0, "start": 1.0, "stop": 2.5, "output_dat": "Day Su\n0 5\n"}'
BLOCK = 256


def raw(path, ids, block=BLOCK, extra=b""):
    with open(path, "ab") as f:
        for i in ids:
            f.write((REC % (i, i % 3)).encode().ljust(block, b"\x00"))
        f.write(extra)


def sink(spark, ids, out, mode="append", parts=3):
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(parts)
    df = df.select(F.format_string('{"task_id": %d, "params_id": %d, "start": 1.0, "stop": 2.5, "output_dat": "Day\\n1\\n"}',
                                   "id", F.col("id") % 3).alias("value"))
    df.write.format("blocklog").mode(mode).option("blockSize", str(BLOCK)).save(out)


def ids(df):
    return sorted(r.task_id for r in parse_records(df).select("task_id").collect())


def log(spark, path, block=BLOCK):
    return spark.read.format("blocklog").option("blockSize", str(block)).load(path)


def test_filters_on_one_scan_do_not_meet(spark, tmp):
    sink(spark, range(60), f"{tmp}/log", parts=2)
    df = B.scan_blocks(spark, f"{tmp}/log", BLOCK)
    few, one = df.where(F.col("block_idx").isin(1, 2)), df.where("block_idx = 5")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("Filter block_idx")  # the filter is below the read
    assert (few.count(), one.count(), df.count()) == (4, 2, 60)
    assert few.unionByName(one).count() == 6 and few.join(one, "path").count() == 4
    assert ids(df) == list(range(60))


def test_filtered_scan_reads_no_other_block(spark, tmp):
    """Files that no filter admits may be gone when the query runs."""
    sink(spark, range(60), f"{tmp}/log", parts=2)
    df = B.scan_blocks(spark, f"{tmp}/log", BLOCK)
    paths = sorted(p for p, _ in B.list_log_files(f"{tmp}/log"))
    assert len(paths) == 2
    os.remove(paths[1])
    assert df.where(F.col("path") == paths[0]).count() > 0
    with pytest.raises(Exception):
        df.count()


def test_killed_job_and_retried_task_leave_the_log_unchanged(spark, tmp):
    out = f"{tmp}/log"
    sink(spark, range(10), out)
    before = ids(log(spark, out))
    # a job that was killed after its tasks, and a task attempt that lost
    raw(f"{out}/part-00000-000-deadbeef-77.log", [100, 101])
    assert ids(log(spark, out)) == before == list(range(10))
    with pytest.raises(Exception):  # a job that fails half-way
        bad = spark.range(40).repartition(4).select(F.when(F.col("id") == 39, F.repeat(F.lit("x"), 999)).otherwise("{}").alias("value"))
        bad.write.format("blocklog").mode("append").option("blockSize", str(BLOCK)).save(out)
    assert ids(log(spark, out)) == before
    sink(spark, range(10, 14), out)
    assert ids(log(spark, out)) == list(range(14))
    sink(spark, [7], out, mode="overwrite")
    assert ids(log(spark, out)) == [7]
    sink(spark, [8], out)
    assert ids(log(spark, out)) == [7, 8]


def test_commit_is_one_rename(spark, tmp, monkeypatch):
    sink(spark, range(12), f"{tmp}/log", parts=4)
    filesystem, root, _ = B._fs(f"{tmp}/log")
    moves = []

    class Counting:
        def __getattr__(self, name):
            return getattr(filesystem, name)

        def move(self, a, b):
            moves.append(b)
            filesystem.move(a, b)

    B.add_manifest(Counting(), root, "many", [[f"f{i}.log", 0, BLOCK] for i in range(1000)])
    assert len(moves) == 1


def test_a_plain_folder_keeps_its_files_when_appended(spark, tmp):
    os.makedirs(f"{tmp}/log")
    raw(f"{tmp}/log/old.log", [1, 2])
    sink(spark, [3], f"{tmp}/log")
    assert ids(log(spark, f"{tmp}/log")) == [1, 2, 3]


def test_index_reads_new_blocks_only_and_lookups_no_others(spark, tmp):
    path, index = f"{tmp}/a.log", f"{tmp}/index"
    assert blockindex.extend(spark, path, index, BLOCK) == 0 if os.path.exists(path) else True
    raw(path, range(8), extra=(REC % (8, 0)).encode()[:20])
    assert blockindex.extend(spark, path, index, BLOCK) == 8  # the half-written block waits
    with open(path, "r+b") as f:  # what is indexed is not read again: spoil it, but for block 2
        for i in (0, 1, 3, 4, 5, 6, 7):
            f.seek(i * BLOCK)
            f.write(b"x" * BLOCK)
        f.seek(8 * BLOCK)
        f.write((REC % (8, 0)).encode().ljust(BLOCK, b"\x00"))
        f.write((REC % (2, 0)).encode().ljust(BLOCK, b"\x00"))  # a run done again
    assert blockindex.extend(spark, path, index, BLOCK) == 2
    assert blockindex.extend(spark, path, index, BLOCK) == 0
    rows = {(r.task_id, r.block_idx) for r in blockindex.entries(spark, index).collect()}
    assert rows == {(i, i) for i in range(9)} | {(2, 9)}
    assert sorted(r.block_idx for r in blockindex.lookup(spark, index, [2, 5, 77]).collect()) == [2, 5, 9]
    want = spark.createDataFrame([(2,), (8,), (2,)], "task_id long")
    got = blockindex.fetch(spark, index, want, BLOCK)
    assert sorted((r.task_id, r.block_idx) for r in got.collect()) == [(2, 2), (2, 9), (8, 8)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan" not in plan and "Scan parquet" in plan


def test_failed_index_batch_is_not_seen(spark, tmp, monkeypatch):
    path, index = f"{tmp}/a.log", f"{tmp}/index"
    raw(path, range(4))
    monkeypatch.setattr(blockindex, "add_manifest", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        blockindex.extend(spark, path, index, BLOCK)
    monkeypatch.undo()
    assert blockindex.entries(spark, index).count() == 0
    assert blockindex.extend(spark, path, index, BLOCK) == 4 and blockindex.entries(spark, index).count() == 4


@pytest.mark.parametrize("plain", [True, False])
def test_backlog_takes_bounded_batches(spark, tmp, plain):
    path, ck, out = f"{tmp}/log", f"{tmp}/ck", f"{tmp}/sink"

    def grow(lo, hi, parts):
        if plain:
            os.makedirs(path, exist_ok=True)
            for i in range(parts):
                raw(f"{path}/f{i}.log", range(lo + i, hi, parts))
        else:
            sink(spark, range(lo, hi), path, parts=parts)

    def batches():
        return sorted(int(n) for n in os.listdir(f"{ck}/commits") if n.isdigit())

    grow(0, 23, 2)
    tail.append_records(spark, path, out, ck, BLOCK, max_blocks=5)
    assert len(batches()) == 5  # ceil(23 / 5)
    grow(23, 30, 2)
    tail.append_records(spark, path, out, ck, BLOCK, max_blocks=5)  # a new query on the same checkpoint
    assert len(batches()) == 7
    tail.append_records(spark, path, out, ck, BLOCK, max_blocks=5)
    assert len(batches()) == 7
    assert sorted(r.task_id for r in spark.read.parquet(out).collect()) == list(range(30))


def test_offset_does_not_grow_with_commits(spark, tmp):
    path = f"{tmp}/log"
    sizes = []
    for i in range(4):
        sink(spark, range(i * 6, i * 6 + 6), path, parts=3)
        reader = B.BlockLogStreamReader({"path": path, "blockSize": str(BLOCK)})
        sizes.append(len(json.dumps(reader.latestOffset())))
    assert max(sizes) == min(sizes)
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert sum(p.stop - p.first for p in parts) == 24


def test_stream_finds_each_files_stride(spark, tmp):
    os.makedirs(f"{tmp}/log")
    raw(f"{tmp}/log/a.log", [1], 160)
    raw(f"{tmp}/log/b.log", [2, 3, 4], 320)
    raw(f"{tmp}/log/c.log", [], extra=(REC % (5, 0)).encode()[:50])  # its first block is still written
    batch = spark.read.format("blocklog").option("blockSize", "auto").load(f"{tmp}/log")
    assert ids(batch) == [1, 2, 3, 4]
    out, ck = f"{tmp}/out", f"{tmp}/ck"
    tail.append_records(spark, f"{tmp}/log", out, ck, "auto")
    assert sorted(r.task_id for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4]
    with open(f"{tmp}/log/c.log", "r+b") as f:
        f.write((REC % (5, 0)).encode().ljust(200, b"\x00"))
    raw(f"{tmp}/log/c.log", [6], 200)
    raw(f"{tmp}/log/a.log", [7], 160)
    tail.append_records(spark, f"{tmp}/log", out, ck, "auto")
    assert sorted(r.task_id for r in spark.read.parquet(out).collect()) == list(range(1, 8))


def test_running_counts_hold_one_row_a_group(spark, tmp):
    path, out, ck = f"{tmp}/a.log", f"{tmp}/counts", f"{tmp}/ck"
    for i in range(5):
        raw(path, range(i * 10, i * 10 + 10))
        tail.running_counts(spark, path, out, ck, BLOCK, max_blocks=4)
    assert tail.merged_batches(out) == 15  # five times ceil(10 / 4)
    rows = sorted((r.params_id, r.n_ok, r.run_time) for r in tail.latest_counts(spark, out).collect())
    assert rows == [(0, 17, 25.5), (1, 17, 25.5), (2, 16, 24.0)]
    stored = spark.read.option("recursiveFileLookup", "true").schema("n_ok long").parquet(*[
        f"{out}/{d}" for d in os.listdir(out) if d.startswith("batch")]).count()
    assert stored <= 9  # this version and the two before, not one for each of 15 batches
    delta = spark.createDataFrame([(0, 100, 1.0)], "params_id long, n_ok long, run_time double")
    tail.merge_counts(spark, delta, out, "batch-00000003")  # a batch replayed
    assert rows == sorted((r.params_id, r.n_ok, r.run_time) for r in tail.latest_counts(spark, out).collect())
