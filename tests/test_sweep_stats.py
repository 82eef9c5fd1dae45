"""Sweep expansion, row numbering, stats and agents on small inputs."""

from pyspark.sql import functions as F

from sweepframe.operators import agents as A
from sweepframe.operators import stats as S
from sweepframe.operators import sweep as W


def test_index_rows_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("k"))
    out = W.index_rows(df, "n", order_by=["k"]).collect()
    assert sorted(r.n for r in out) == list(range(1, 1001))
    assert all(r.n == r.k + 1 for r in out)


def test_grid_ids(spark):
    days = spark.createDataFrame([(0, 10), (1, 11)], "day_pos int, day int")
    g = W.grid(days, F.array(F.lit(0.1), F.lit(0.2)), F.array(F.lit(0.5), F.lit(0.6), F.lit(0.7))).collect()
    ids = {(r.day, r.p_trans, r.compliance): r.sample_id for r in g}
    assert sorted(ids.values()) == list(range(12))
    assert ids[(11, 0.1, 0.5)] == 6


def test_replicates(spark):
    p = spark.createDataFrame([(1,), (2,)], "params_id long")
    r = W.expand_replicates(p, 3).collect()
    assert sorted((x.params_id, x.seed, x.task_id) for x in r) == [
        (1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 0, 3), (2, 1, 4), (2, 2, 5)]


def test_stdout_timings_last_wins_and_summary(spark):
    rows = [("f1", 0, "TIME: SETUP: 1.0"), ("f1", 1, "TIME: SETUP: 2.0"), ("f1", 2, "TIME: SIM: 3.0"),
            ("f2", 0, "TIME: SETUP: 4.0"), ("f2", 1, "EARLY-EXIT now"),
            ("f3", 0, "TIME: SIM: 10.0")]
    df = spark.createDataFrame(rows, "file string, pos long, line string").withColumn(
        "line_key", F.struct(F.lit(0).alias("split"), F.col("pos").alias("pos")))
    t = {r.file: r for r in S.stdout_timings(df).collect()}
    assert (t["f1"].setup, t["f1"].sim, t["f1"].early) == (2.0, 3.0, False)
    assert t["f2"].early
    s = {r.series: r for r in S.timing_summary(S.stdout_timings(df)).collect()}
    assert s["SETUP"].n == 1 and s["SIM"].n == 2 and s["SIM"].median == 6.5
    assert s["TOTAL"].n == 1 and s["TOTAL"].total == 5.0


def test_require_runs_raises(spark):
    exp = spark.createDataFrame([("s", "r1"), ("s", "r2")], "seed string, run string")
    found = spark.createDataFrame([("s", "r1")], "seed string, run string")
    import pytest
    with pytest.raises(Exception):
        A.require_runs(exp, found, ["seed", "run"]).collect()


def test_narrow_widens_unsigned(spark):
    df = spark.createDataFrame([(65535, 1.5)], "treatment_timer long, position_x double")
    out = A.narrow(df, {"treatment_timer": "uint16", "position_x": "float16"})
    assert dict(out.dtypes) == {"treatment_timer": "int", "position_x": "float"}


def test_series_one_pass_matches_two_step(spark):
    from sweepframe.operators import scrape as R

    lines = [(1, 0, "[Day 0 x y z 5; w 0"), (1, 1, "noise"), (1, 2, "[Day 1 x y z 7; w 1"), (2, 0, "nothing here")]
    df = spark.createDataFrame(lines, "task_id long, pos long, line string").withColumn(
        "line_key", F.struct(F.lit("f").alias("file"), F.lit(0).alias("split"), F.col("pos").alias("pos")))
    one = {r.task_id: (r.day_final, r.infected, r.deaths) for r in R.series_from_stdout(df).collect()}
    two = {r.task_id: (r.day_final, r.infected, r.deaths)
           for r in R.collect_series(R.scrape_days(df), df.select("task_id").distinct()).collect()}
    assert one == two == {1: (1, [5, 7], [0, 1]), 2: (0, [], [])}


def test_require_runs_check_is_not_pruned(spark):
    import pytest

    exp = spark.createDataFrame([("s", "r1"), ("s", "r2")], "seed string, run string")
    found = spark.createDataFrame([("s", "r1")], "seed string, run string")
    for use in (lambda d: d.count(), lambda d: d.select("seed").collect(), lambda d: exp.join(d, ["seed", "run"], "left_anti").collect()):
        with pytest.raises(Exception):
            use(A.require_runs(exp, found, ["seed", "run"]))
    assert A.require_runs(found, exp, ["seed", "run"]).count() == 1


def test_last_run_by_number_and_agreement(spark):
    rows = [("s", f"run_{i:05d}", 0, 1, i, None if i == 5 else 7) for i in range(1002)]
    snap = spark.createDataFrame(rows, "seed string, run_path string, step int, agent_idx long, FIPS int, Tract int")
    r = A.location_dim(A.merge_sims(snap)).first()
    assert (r.FIPS, r.Tract, r.consistent) == (1001, 7, False)
    same = A.location_dim(A.merge_sims(snap.drop("FIPS").where("Tract = 7"))).first()
    assert same.consistent


def test_runs_in_an_explicit_order(spark):
    snap = spark.createDataFrame([("s", p, 0, 1) for p in "abc"], "seed string, run_path string, step int, agent_idx long")
    order = spark.createDataFrame([("s", "c", 0), ("s", "a", 1), ("s", "b", 2)], "seed string, run_path string, run_no int")
    got = {r.run_path: r.sim for r in A.sim_index(snap, order=order).collect()}
    assert got == {"c": "sim_000", "a": "sim_001", "b": "sim_002"}


def test_value_tables_of_any_length(spark):
    seeds = spark.range(1, 3).select(F.col("id").alias("seed"))
    values = W.value_table(spark.range(2000).select((F.col("id") * 2).alias("v")), "v")
    out = W.seed_sweep(seeds, values, "in", "out").orderBy("i").collect()
    assert len(out) == 4000 and [r.i for r in out] == list(range(1, 4001)) and out[2000].p_trans == 0
    assert W.study(spark.range(2), values.where("pos < 0")).count() == 0


def test_no_replicates_give_no_rows(spark):
    rows = spark.createDataFrame([(1, 0), (2, 2), (3, -1), (4, None)], "params_id long, r long")
    got = sorted((r.params_id, r.seed, r.task_id) for r in W.expand_replicates(rows, F.col("r")).collect())
    assert got == [(2, 0, 2), (2, 1, 3)]
    assert W.expand_replicates(rows, 0).count() == 0


def joins(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Join [" in line and "pos" in line]


def test_multiplied_runs_are_never_broadcast(spark, monkeypatch):
    """The planner sees few seeds, not the rows they become."""
    seeds = spark.range(1, 50).withColumnRenamed("id", "seed")
    values = W.value_table(spark.range(7).select((F.col("id") * 2).alias("v")), "v")
    short = W.seed_sweep(seeds, values, "in", "out")
    assert all("BuildRight" in j for j in joins(short)) and joins(short)
    monkeypatch.setattr(W, "VALUE_ROWS", 3)
    long = W.seed_sweep(seeds, values, "in", "out")
    assert any("SortMergeJoin" in j for j in joins(long)) and not any("BuildLeft" in j for j in joins(long))
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, short.collect()))
    assert long.count() == 49 * 7
