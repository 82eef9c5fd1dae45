"""Every registered query runs at sf0.001 and matches its DuckDB oracle."""

import os

import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return float(f"{v:.12g}")
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


import __spark_entry__ as E  # noqa: E402

NAMES = sorted(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert canon(df.columns, rows) == canon(dcols, res.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
