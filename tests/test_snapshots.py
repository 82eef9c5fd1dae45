"""Steps and runs from the listing; agent rows are neither moved nor scanned twice."""

import re

import pytest
from pyspark.sql import functions as F

from sweepframe.operators import agents as A
from sweepframe.session import scratch_path
from sweepframe.sources import text


@pytest.fixture
def root(spark):
    """Run names that need escaping, numbered seeds, uneven steps, a field of later steps."""
    rows = [(7, "a b/c+d", "plt00010", 1, 10, None), (7, "a b/c+d", "plt00020", 1, 11, 1), (7, "a b/c+d", "plt00020", 2, 12, 0),
            (7, "z%", "plt00000", 1, 13, None), (8, "a b/c+d", "plt00020", 5, 14, 2)]
    df = spark.createDataFrame(rows, "seed int, run string, plt string, agent_idx long, status int, extra int")
    path = scratch_path(spark, "snapshot_test")
    df.where("extra IS NULL").drop("extra").write.partitionBy("seed", "run", "plt").parquet(path)
    df.where("extra IS NOT NULL").write.mode("append").partitionBy("seed", "run", "plt").parquet(path)
    return path


WANT = [("7", "a b/c+d", 0, 1, 10, None), ("7", "a b/c+d", 1, 1, 11, 1), ("7", "a b/c+d", 1, 2, 12, 0),
        ("7", "z%", 0, 1, 13, None), ("8", "a b/c+d", 0, 5, 14, 2)]
FIELDS = "agent_idx long, status int, extra int"


@pytest.mark.parametrize("schema,limit", [(FIELDS, 100), (FIELDS, 1), (None, 100), (None, 1)])
def test_steps(spark, root, schema, limit):
    snap = text.read_snapshots(spark, root, schema, limit)
    got = snap.select(F.col("seed").cast("string"), "run", "step", "agent_idx", "status", "extra").collect()
    assert sorted(map(tuple, got), key=str) == sorted(WANT, key=str)


def test_names_that_read_as_numbers(spark):
    path = scratch_path(spark, "snapshot_test")
    rows = [("007", "1", "2", 1), ("007", "1", "10", 1)]
    df = spark.createDataFrame(rows, "seed string, run string, plt string, agent_idx long")
    df.write.partitionBy("seed", "run", "plt").parquet(path)
    typed = {(r.seed, r.step) for r in text.read_snapshots(spark, path).collect()}
    named = {(r.seed, r.step) for r in text.read_snapshots(spark, path, "agent_idx long").collect()}
    assert typed == {(7, 0), (7, 1)} and named == {("007", 0), ("007", 1)}


def test_merge_moves_no_agent_row(spark, root):
    runs = text.run_index(spark, root).withColumnRenamed("run", "run_path")
    snap = text.read_snapshots(spark, root, FIELDS).withColumnRenamed("run", "run_path")
    merged = A.merge_sims(snap, runs=runs)
    assert sorted((r.seed, r.sim, r.step, r.agent_idx) for r in merged.collect()) == [
        ("7", "sim_000", 0, 1), ("7", "sim_000", 1, 1), ("7", "sim_000", 1, 2), ("7", "sim_001", 0, 1), ("8", "sim_000", 0, 5)]
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "SortMergeJoin" not in plan
    assert len(re.findall("BroadcastHashJoin", plan)) == 2


@pytest.mark.parametrize("limit,hinted", [(4, True), (3, False)])
def test_long_indexes_are_not_broadcast(spark, root, limit, hinted):
    """The index of four rows is broadcast only within the limit."""
    plan = text.read_snapshots(spark, root, FIELDS, limit)._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == hinted


def test_explicit_order(spark, root):
    runs = text.run_index(spark, root).withColumnRenamed("run", "run_path")
    order = runs.withColumn("run_no", F.when(F.col("run_path") == "z%", 0).otherwise(1))
    snap = text.read_snapshots(spark, root, FIELDS).withColumnRenamed("run", "run_path")
    got = {(r.seed, r.status): r.sim for r in A.merge_sims(snap, order=order, runs=runs).collect()}
    assert got[("7", 13)] == "sim_000" and got[("7", 10)] == "sim_001" and got[("8", 14)] == "sim_000"
