"""Validation (V1-V5): a faithful table passes, a damaged one fails."""

import os

from pyspark.sql import functions as F

from sweepframe.functions.daytable import LONG_SCHEMA, explode_days
from sweepframe.operators import validate as V
from sweepframe.sources.longtable import read_header, write_long


def records(spark):
    rows = [(1, 0, 7, "Day Su A/I\n0 10 1\n1 11 2\n\n"), (2, 0, 8, "Day Su\n0 20\n1 21 9\n2\n")]
    return spark.createDataFrame(rows, "task_id long, params_id long, seed long, output_dat string")


def test_faithful_table_passes(spark, tmp):
    recs = records(spark)
    p = os.path.join(tmp, "long")
    write_long(explode_days(recs), p, header={"date": "d"})
    assert read_header(spark, p) == {"date": "d"}
    from sweepframe.sources.longtable import header_table
    assert [tuple(r) for r in header_table(spark, p).collect()] == [("date", "d")]
    assert spark.read.parquet(p).count() == 4
    out = {r.check: (r.failures, r.status) for r in V.validate(spark, p, recs, LONG_SCHEMA).collect()}
    # run 2 has a short row: the converter drops it, the row count check does not
    assert out["rows"][1] == "FAIL" and out["values"] == (0, "PASS") and out["magic"] == (0, "PASS")
    rows = {r.row_id: r.status for r in V.check_rows(spark.read.parquet(p), recs).collect()}
    assert rows == {1: "OK", 2: "MISMATCH"}


def test_damaged_table_fails(spark, tmp):
    recs = records(spark).where("task_id = 1")
    p = os.path.join(tmp, "bad")
    long = explode_days(recs).withColumn("Su", F.when(F.col("Day") == 1, F.lit(99.0).cast("float")).otherwise(F.col("Su")))
    write_long(long, p)
    bad = V.value_mismatches(spark.read.parquet(p), recs).collect()
    assert [(r.row_id, r.Day, r.column, r.want) for r in bad] == [(1, 1, "Su", 11.0)]
    out = {r.check: r.status for r in V.validate(spark, p, recs, LONG_SCHEMA).collect()}
    assert out["values"] == "FAIL" and out["verdict"] == "FAIL"
    # a schema that differs from the reference fails V2
    sch = V.check_schema(spark, spark.read.parquet(p).drop("NewH").schema, LONG_SCHEMA)
    assert sch.where("status = 'MISMATCH'").count() == 1


def test_log_to_long_counters(spark, tmp):
    from sweepframe.plans.convert import log_to_long, validate_log

    log = os.path.join(tmp, "run.log")
    recs = ['{"header": "true", "date": "t"}',
            '{"task_id": 1, "seed": 3, "output_dat": "Day Su\\n0 1\\n1 2\\n"}',
            '{"task_id": 2, "seed": 4, "output_dat": "Day Su\\n0 5\\n"}']
    with open(log, "wb") as f:
        for r in recs:
            f.write(r.encode().ljust(512, b"\x00"))
    out = os.path.join(tmp, "long")
    c = log_to_long(spark, log, out, block_size=512)
    assert (c["records"], c["rows"], c["expected_blocks"], c["header"]) == (2, 3, 3, {"date": "t"})
    v = {r.check: r.status for r in validate_log(spark, out, log, block_size=512).collect()}
    assert v["verdict"] == "PASS"


def test_fractions_pass_and_damage_fails(spark, tmp):
    """Values beyond float precision agree with a faithful table; each kind of damage is seen."""
    import json

    from pyspark.sql import functions as F

    from sweepframe.plans.convert import log_to_long, validate_log

    recs = [{"task_id": i, "params_id": 1, "seed": 2, "output_dat": f"Day Su A/I\n1 100.1 12345.67\n2 {i}.3 1e-7\n"} for i in range(4)]
    log, out = tmp + "/v.log", tmp + "/v_long"
    with open(log, "wb") as f:
        for r in recs:
            f.write(json.dumps(r).encode().ljust(256, b"\0"))
    c = log_to_long(spark, log, out, block_size="auto")
    assert (c["records"], c["rows"], c["expected_blocks"], c["rejects"]) == (4, 8, 4, 0)
    assert {r.check: r.status for r in validate_log(spark, out, log, "auto").collect()}["verdict"] == "PASS"
    good = spark.read.parquet(out)
    damaged = {"missing": good.where("row_id <> 3"), "extra": good.union(good.where("row_id = 0").withColumn("row_id", F.lit(9).cast("long"))),
               "cell": good.withColumn("Su", F.when((F.col("row_id") == 1) & (F.col("Day") == 2), F.lit(7).cast("float")).otherwise(F.col("Su"))),
               "twice": good.union(good.where("row_id = 0 AND Day = 1"))}
    for name, df in damaged.items():
        df.write.parquet(f"{tmp}/{name}")
        found = {r.check: r.status for r in validate_log(spark, f"{tmp}/{name}", log, "auto").collect()}
        assert found["verdict"] == "FAIL" and found["values" if name == "cell" else "rows"] == "FAIL", name


def test_quarantine_writes_rejects(spark, tmp):
    import json

    from sweepframe.plans.convert import log_to_long

    log, out = tmp + "/q.log", tmp + "/q_long"
    with open(log, "wb") as f:
        for i, body in enumerate(["Day Su\n1 2\nx 3\n", "Day Su\n1 bad\n2 5\n"]):
            f.write(json.dumps({"task_id": i, "seed": 0, "output_dat": body}).encode().ljust(200, b"\0"))
    c = log_to_long(spark, log, out, 200, mode="quarantine")
    assert (c["rows"], c["rejects"]) == (2, 2)
    assert sorted(r.line for r in spark.read.parquet(out + "_rejects").collect()) == ["1 bad", "x 3"]
    assert sorted((r.row_id, r.Day, r.Su) for r in spark.read.parquet(out).collect()) == [(0, 1, 2.0), (1, 2, 5.0)]


def test_emptied_cells_fail(spark, tmp):
    """A null where the source has a value is a mismatch, also beside a good row of the same Day."""
    recs = spark.createDataFrame([(1, 0, 7, "Day Su A/I\n0 10 1\n1 11 2\n1 11 2\n")],
                                 "task_id long, params_id long, seed long, output_dat string")
    good = explode_days(recs)
    null = {c: F.lit(None).cast(good.schema[c].dataType) for c in ("seed", "Su", "Day")}
    one = good.where("Day = 1").limit(1)
    damaged = {"Su": (good.withColumn("Su", null["Su"]), 2), "seed": (good.withColumn("seed", null["seed"]), 2),
               "Day": (good.withColumn("Day", null["Day"]), 3),
               "one": (good.where("Day = 0").union(one).union(one.withColumn("Su", null["Su"])), 1)}
    for name, (df, cells) in damaged.items():
        df.write.parquet(f"{tmp}/{name}")
        out = {r.check: (r.failures, r.status) for r in V.validate(spark, f"{tmp}/{name}", recs).collect()}
        assert out["rows"] == (0, "PASS") and out["values"] == (cells, "FAIL") and out["verdict"][1] == "FAIL", name
    bad = {r.column: r.n_bad for r in V.check_values(spark.read.parquet(f"{tmp}/Su"), recs).collect()}
    assert bad["Su"] == 5 and bad["seed"] == 0 and bad["A_I"] == 0
    bad = {r.column: r.n_bad for r in V.check_values(spark.read.parquet(f"{tmp}/seed"), recs).collect()}
    assert bad["seed"] == 5 and bad["Su"] == 0
    assert {(r.Day, r.column, r.got) for r in V.value_mismatches(spark.read.parquet(f"{tmp}/seed"), recs).collect()} == {
        (0, "seed", None), (1, "seed", None)}


def test_days_that_repeat_pass_and_are_told_apart(spark, tmp):
    """Cells are multisets: a faithful table passes, a swapped value does not, an exchanged order does."""
    text = "Day Su A/I\n0 1 1\n1 3 1\n1 9 2\n1 3 1\n"
    recs = spark.createDataFrame([(1, 0, 7, text), (2, 0, 7, text)], "task_id long, params_id long, seed long, output_dat string")
    good = explode_days(recs)
    nine = (F.col("row_id") == 2) & (F.col("Su") == 9)
    tables = {"good": (good, 0), "order": (good.orderBy(F.desc("Su")), 0),
              "value": (good.withColumn("Su", F.when(nine, F.lit(3).cast("float")).otherwise(F.col("Su"))), 1),
              "near": (good.withColumn("Su", F.col("Su") + F.lit(5e-7).cast("float")), 0)}
    for name, (df, cells) in tables.items():
        df.coalesce(1).write.parquet(f"{tmp}/{name}")
        table = spark.read.parquet(f"{tmp}/{name}")
        out = {r.check: r.failures for r in V.validate(spark, f"{tmp}/{name}", recs).collect()}
        assert (out["rows"], out["values"], out["verdict"]) == (0, cells, int(cells > 0)), name
        assert sum(r.n_bad for r in V.check_values(table, recs).collect()) >= cells
        if not cells:
            assert all(r.n_bad == 0 for r in V.check_values(table, recs).collect()) and V.value_mismatches(table, recs).count() == 0


def test_column_that_the_header_lacks_must_be_zero(spark, tmp):
    recs = records(spark).where("task_id = 1")
    explode_days(recs).withColumn("R", F.lit(7).cast("float")).write.parquet(f"{tmp}/r")
    out = {r.check: (r.failures, r.status) for r in V.validate(spark, f"{tmp}/r", recs).collect()}
    assert out["values"] == (2, "FAIL") and out["verdict"] == (1, "FAIL")
    bad = {r.column: (r.n_checked, r.n_bad) for r in V.check_values(spark.read.parquet(f"{tmp}/r"), recs).collect()}
    assert bad == {"seed": (2, 0), "Su": (2, 0), "A_I": (2, 0), "R": (0, 2)}


def test_values_of_runs_that_agree_are_not_shuffled(spark, tmp):
    """All columns of both sides were joined; a faithful table needs the rows and the cells present a day."""
    recs = records(spark)
    explode_days(recs).write.parquet(f"{tmp}/long")
    checked = V.check_values(spark.read.parquet(f"{tmp}/long"), recs)
    assert {r.column: (r.n_checked, r.n_bad) for r in checked.collect()} == {"seed": (4, 0), "Su": (4, 0), "A_I": (2, 0)}
    assert "Su:float" not in checked._jdf.queryExecution().executedPlan().toString()
    assert V.value_mismatches(spark.read.parquet(f"{tmp}/long"), recs).count() == 0
