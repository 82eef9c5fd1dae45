import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, docs

from sweepframe.llm import quality as Q
from sweepframe.llm.labelled import held_out, sample
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_statistics_do_not_depend_on_neighbours():
    texts = [t for _, t in awkward()] + ["A | B | C", "x!! y!!", "the the the", "a\nb\n\nc"]
    together = Q.statistics(pa.array(texts))
    for t, row in zip(texts, together):
        assert np.allclose(Q.statistics(pa.array([t], pa.string()))[0], row), t
    at = {n: i for i, n in enumerate(Q.STATISTICS)}
    last = together[-4:]
    assert last[0, at["bars"]] == 2 / 5 and last[0, at["letterless"]] == 2 / 5
    assert last[1, at["exclaims"]] == 2 and last[2, at["repeats"]] == 2 / 3
    assert last[2, at["top_word"]] == 1 and last[2, at["distinct"]] == 1 / 3
    assert not together[0].any() or together[0].tolist() == Q.statistics(pa.array([""]))[0].tolist()


def walk(forest, x):
    """One row through the trees, one node at a time."""
    out = forest.start
    for split, cut, leaf in zip(forest.split, forest.cut, forest.leaf):
        node = 0
        while node < len(split):
            node = 2 * node + (2 if x[split[node]] > cut[node] else 1)
        out += leaf[node - len(split)]
    return 1 / (1 + np.exp(-out))


def test_forest_learns_and_flat_walk_equals_node_walk():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0.3)).astype(float)
    f = Q.fit(x[:2000], y[:2000])
    assert ((f.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9
    assert np.allclose(f.score(x[:50]), [walk(f, r) for r in x[:50]])


@pytest.mark.parametrize("y,want", [([], 0.5), ([1, 1], 0.75), ([0, 0, 0], 0.2)])
def test_labels_of_one_kind(y, want):
    f = Q.fit(np.zeros((len(y), 3)), np.array(y, float))
    assert np.allclose(f.score(np.zeros((2, 3))), want)


def test_sample_leaves_out_held_out_rows(spark):
    rows = [(i, i % 2) for i in range(300)] + [(None, 1), (5, None), (6, 1), (6, 0)]
    got = {r.doc_id: r.label for r in sample(spark.createDataFrame(rows, "doc_id long, quality int"), "quality").collect()}
    assert set(got) == {i for i in range(300) if zlib.crc32(str(i).encode()) % 3 != 1}
    few = sample(spark.createDataFrame(rows, "doc_id long, quality int"), "quality", 10)
    assert few.count() == 10 and {r.doc_id for r in few.collect()} <= set(got)
    assert [r[0] for r in spark.createDataFrame([(None,)], "i long").select(held_out(F.col("i"))).collect()] == [False]


def test_held_out_accuracy(spark):
    d, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(spark, d, labels)
    scored = Q.score(spark, d, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).toPandas()
    assert ((scored["score"] >= 0.5) == (scored["quality"] == 1)).mean() > 0.95


def test_awkward_rows_and_stage(spark):
    d = docs(spark, awkward(), extra=True)
    empty = spark.createDataFrame([], "doc_id long, quality int")
    out = Q.score(spark, d, Q.train(spark, d, empty), "p").collect()
    assert len(out) == d.count() and all(r.p == 0.5 for r in out)
    kept = Q.keep_good(spark, d, empty)
    assert kept.columns == d.columns and kept.count() == d.count()
    assert Q.keep_good(spark, docs(spark, []), empty).count() == 0


def test_repeated_rows_are_one_training_row(spark):
    rows = [(i, ("good words in a line. " if i % 2 else "x " * 9) * (1 + i % 7)) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    a = Q.train(spark, docs(spark, rows), labels)
    b = Q.train(spark, docs(spark, rows * 3), labels, rows=120)
    assert all(np.array_equal(x, y) for x, y in zip((a.split, a.cut, a.leaf), (b.split, b.cut, b.leaf)))
