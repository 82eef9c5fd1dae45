"""Parameter sources (S9, S10, S11, S16), random seeds (G6) and the scrape hook."""

import os

import pytest
from pyspark.sql import functions as F

from sweepframe.operators import scrape as R
from sweepframe.operators import sweep as W
from sweepframe.sources import text


def test_params_csv_strings_and_short_row(spark, tmp):
    p = os.path.join(tmp, "p.csv")
    with open(p, "w") as f:
        f.write('a.b,c,d\n1,"[1.0, 2.0]",x\n0.0001,2,y\n')
    df = text.read_params_csv(spark, p)
    rows = df.collect()
    assert df.dtypes == [("a.b", "string"), ("c", "string"), ("d", "string")]
    assert rows[0]["c"] == "[1.0, 2.0]" and rows[1]["a.b"] == "0.0001"
    bad = os.path.join(tmp, "bad.csv")
    with open(bad, "w") as f:
        f.write("a,b,c\n1,2,3\n4,5\n")
    with pytest.raises(Exception):
        text.read_params_csv(spark, bad).select("a").collect()
    blank = os.path.join(tmp, "blank.csv")
    with open(blank, "w") as f:
        f.write("a,b\n1,2\n\n3,4\n")
    with pytest.raises(ValueError):
        text.read_params_csv(spark, blank)


def test_params_jsonl_raw_values_and_missing_instance(spark, tmp):
    p = os.path.join(tmp, "u.txt")
    with open(p, "w") as f:
        f.write('{"disease.p_trans": 0.0001, "disease.CHR": [0.1, 0.2], "instance": 3, "replicates": [0, 1]}\n\n')
    r = text.read_params_jsonl(spark, p).collect()
    assert len(r) == 1 and r[0].instance == 3
    assert r[0].params == {"disease.p_trans": "0.0001", "disease.CHR": "[0.1, 0.2]"}
    q = os.path.join(tmp, "v.txt")
    with open(q, "w") as f:
        f.write('{"a": 1}\n')
    with pytest.raises(Exception):
        text.read_params_jsonl(spark, q).collect()


def test_config_lines_and_manifest(spark, tmp):
    p = os.path.join(tmp, "c.cfg")
    with open(p, "w") as f:
        f.write("# c\n  agent.seed = 4\nx=y z\n\n")
    rows = text.read_configs(spark, p).orderBy("line_no").collect()
    assert [(r.line_no, r.key, r.val) for r in rows] == [(0, None, None), (1, "agent.seed", "4"), (2, "x", "y z"), (3, None, None)]
    m = os.path.join(tmp, "m")
    df = spark.createDataFrame([("a_1.bay", 1, 0.0001)], "fname string, seed int, p_trans double")
    text.write_manifest(df, m)
    assert text.read_manifest(spark, m).collect()[0].asDict() == {"fname": "a_1.bay", "seed": 1, "p_trans": 0.0001}


def test_random_seeds_reproducible(spark):
    runs = spark.range(0, 100, 1, 4).select(F.col("id").alias("idx"))
    a = W.random_seeds(runs, 0, 99999, seed=3).collect()
    b = W.random_seeds(runs, 0, 99999, seed=3).collect()
    assert a == b and all(0 <= r.seed <= 99999 for r in a)
    assert a[5].name == "seed_05_%05d" % a[5].seed


def test_scrape_hook(spark):
    df = spark.createDataFrame([(1, "x" * 3), (2, "")], "task_id long, text string")
    out = R.with_scrape(df, lambda d: {"n": len(d["text"]), "tag": "t"}, "n long, tag string", ["text"])
    assert sorted((r.task_id, r.n, r.tag) for r in out.collect()) == [(1, 3, "t"), (2, 0, "t")]


def test_file_order_numbering_across_splits(spark, tmp):
    d = os.path.join(tmp, "csvs")
    os.makedirs(d)
    n_per = 3000
    for f in range(3):
        with open(os.path.join(d, f"part-{f:05d}.csv"), "w") as fh:
            fh.write("k,v\n")
            for i in range(n_per):
                fh.write(f"{f * n_per + i},x{i}\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")  # many splits per file
    try:
        df = text.read_params_csv(spark, d)
        assert df.rdd.getNumPartitions() > 3
        out = W.index_in_file_order(df.select("*", *text.line_key_cols()), "params_id")
        rows = out.select("k", "params_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 3 * n_per
    assert all(int(r.k) + 1 == r.params_id for r in rows)


def test_scrape_hook_keeps_large_ids(spark):
    from sweepframe.operators.scrape import with_scrape

    df = spark.createDataFrame([(9007199254740993, "a"), (None, "bb")], "id long, t string")
    out = with_scrape(df, lambda r: {"n": len(r["t"]), "same": r["id"]}, "n int, same long", ["t", "id"])
    assert sorted(tuple(r) for r in out.where("id IS NOT NULL").collect()) == [(9007199254740993, "a", 1, 9007199254740993)]
    assert out.where("id IS NULL").select("n").first()[0] == 2
    assert out.columns == ["id", "t", "n", "same"]


def test_params_checks_are_not_pruned(spark, tmp):
    import pytest

    from sweepframe.sources.text import read_params_csv, read_params_jsonl

    for i, line in enumerate(['{"a": 1}', '{"instance": 1, "a": 0.10, "b": [1', '{"instance": 1, "b": [[1, 2], [3]]}']):
        path = f"{tmp}/p{i}.jsonl"
        with open(path, "w") as f:
            f.write('{"instance": 3, "a": [1, 2]}\n' + line + "\n")
        for use in (lambda d: d.count(), lambda d: d.select("params").collect(), lambda d: d.select("file").collect()):
            with pytest.raises(Exception):
                use(read_params_jsonl(spark, path))
    for name, header in (("x", "x,y"), ("y", "y,x")):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(f"{header}\n1,2\n")
    with pytest.raises(Exception):
        read_params_csv(spark, f"{tmp}/*.csv").collect()
