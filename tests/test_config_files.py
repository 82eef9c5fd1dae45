"""One file per config, and parameter CSVs with headers of their own."""

import os

import pytest
from pyspark.sql import functions as F

from sweepframe.operators import sweep as W
from sweepframe.sources.namedfiles import NamedFilesWriter, read_named, write_configs
from sweepframe.sources.text import read_params_csvs


def configs(spark, rows):
    return spark.createDataFrame(rows, "name string, config string").repartition(3)


def tree(path):
    return {os.path.relpath(os.path.join(b, f), path): open(os.path.join(b, f), newline="").read() for b, _, fs in os.walk(path) for f in fs}


def test_one_file_a_row(spark, tmp):
    rows = [(f"{i:03d}/a b {i}.cfg", f"x = {i}\r\né\n" * (i % 3)) for i in range(40)]
    write_configs(configs(spark, rows), f"{tmp}/out")
    assert tree(f"{tmp}/out") == dict(rows) | {"_SUCCESS": ""}
    write_configs(configs(spark, [("z.cfg", "1")]), f"{tmp}/out")  # overwrite: the old set goes
    assert tree(f"{tmp}/out") == {"z.cfg": "1", "_SUCCESS": ""} and os.listdir(tmp) == ["out"]
    write_configs(configs(spark, [("y.cfg", "2")]), f"{tmp}/out", mode="append")
    assert set(tree(f"{tmp}/out")) == {"y.cfg", "z.cfg", "_SUCCESS"}
    write_configs(configs(spark, []), f"{tmp}/none")
    assert tree(f"{tmp}/none") == {"_SUCCESS": ""}


@pytest.mark.parametrize("rows", [[("a", "1"), ("a", "2")], [("../a", "1")], [("_a", "1")], [("a", None)], [(None, "1")]])
def test_bad_rows_leave_the_old_set(spark, tmp, rows):
    write_configs(configs(spark, [("old.cfg", "1")]), f"{tmp}/out")
    with pytest.raises(Exception):
        write_configs(configs(spark, rows), f"{tmp}/out")
    assert tree(f"{tmp}/out") == {"old.cfg": "1", "_SUCCESS": ""}


def test_a_task_done_twice_and_a_killed_job(tmp):
    import pyarrow as pa

    w = NamedFilesWriter({"path": f"{tmp}/out"}, True)
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b"], "text": ["1", "2"]})
    w.write(iter([batch]))
    done = w.write(iter([batch]))  # the attempt that counts
    assert not os.path.exists(f"{tmp}/out")  # nothing to be seen before the commit
    w.commit([done, None])
    assert tree(f"{tmp}/out") == {"a": "1", "b": "2", "_SUCCESS": ""}
    killed = NamedFilesWriter({"path": f"{tmp}/out"}, True)
    killed.write(iter([batch.slice(0, 1)]))
    assert tree(f"{tmp}/out") == {"a": "1", "b": "2", "_SUCCESS": ""}
    killed.abort([])
    assert os.listdir(tmp) == ["out"]


def write(path, text):
    with open(path, "w", newline="") as f:
        f.write(text)


def rows(spark, paths):
    out = W.index_in_file_order(read_params_csvs(spark, paths), "id")
    return [(r.id, r.params) for r in out.orderBy("id").collect()]


def test_headers_of_their_own_and_ids_that_continue(spark, tmp):
    write(f"{tmp}/b.csv", 'x,y\n1,"[2, 3]"\n\n"a ""q"" b",\n')
    write(f"{tmp}/a.csv", "y,z,z\r\n7,8,9\r\n,,\r\n5,6,7,extra\r\n")
    write(f"{tmp}/c.csv", "only,header\n")
    write(f"{tmp}/d.csv", 'u\nb"c\n"a,b"\n')
    assert rows(spark, [f"{tmp}/b.csv", f"{tmp}/c.csv", f"{tmp}/a.csv", f"{tmp}/d.csv"]) == [
        (1, {"x": "1", "y": "[2, 3]"}), (2, {"x": 'a "q" b', "y": ""}),
        (3, {"y": "7", "z": "9"}), (4, {"y": "", "z": ""}), (5, {"y": "5", "z": "7"}), (6, {"u": 'b"c'}), (7, {"u": "a,b"})]


@pytest.mark.parametrize("line", ["1", 'a,"b', '"a"b,c', 'a,"'])
def test_malformed_rows_fail(spark, tmp, line):
    write(f"{tmp}/p.csv", f"x,y\n1,2\n{line}\n")
    with pytest.raises(Exception):
        read_params_csvs(spark, [f"{tmp}/p.csv"]).select(F.count("params")).collect()


def test_rows_of_many_splits_keep_their_order(spark, tmp):
    write(f"{tmp}/p.csv", "x,y\n" + "".join(f"{i},v{i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = rows(spark, [f"{tmp}/p.csv"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i + 1, {"x": str(i), "y": f"v{i}"}) for i in range(5000)]


def test_files_are_read_back_by_name_without_a_listing(spark, tmp, monkeypatch):
    """Both the commit and the read listed the whole set on the driver."""
    rows = [(f"{i:03d}/a b%20 {i}.cfg", f"x = {i}\r\né\n" * (i % 3)) for i in range(50)]
    monkeypatch.setattr(NamedFilesWriter, "_visible", lambda *a: 1 / 0)
    path = write_configs(configs(spark, rows), f"{tmp}/out")
    back = read_named(configs(spark, rows), path)
    assert sorted(map(tuple, back.collect())) == rows
    assert read_named(configs(spark, []), path).collect() == []
    with open(f"{tmp}/out/007/a b%20 7.cfg", "w") as f:
        f.write("changed")
    assert back.where("name LIKE '007/%'").first().text == "changed"  # the files themselves are read
    os.remove(f"{tmp}/out/008/a b%20 8.cfg")
    with pytest.raises(Exception):
        read_named(configs(spark, rows), path).collect()
