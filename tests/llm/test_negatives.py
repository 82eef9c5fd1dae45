import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sweepframe.llm import negatives as N

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("rid", T.StringType()),
                       T.StructField("score", T.StringType()), T.StructField("slot", T.StringType())])


def brute(rows, k=5):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows if i is not None and y is not None and fine(v)]
    out = []
    for i, q, y in ints:
        if i % 5:
            continue
        near = sorted((-sum(a * b for a, b in zip(q, v)), j, z) for j, v, z in ints if j != i)
        for s, j, _ in [n for n in near if n[2] == y][:k]:
            p = -s
            hard = [(j2, -s2) for s2, j2, z in near if z != y and 80 * p <= -100 * s2 <= 100 * p][:k]
            out += [(i, j, r + 1, j2, p, s2) for r, (j2, s2) in enumerate(hard)]
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame([(i, v, y, "a", "b", "c") for i, v, y in rows], SCHEMA)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in N.mine(spark, df, F.col("vec_id") % 5 == 0).select(*cols).collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "CELLS", 300)  # many blocks
    monkeypatch.setattr(N, "ANCHORS", 7)
    rnd = np.random.default_rng(0)
    rows = [(i, (rnd.normal(size=6) + 1).tolist(), int(rnd.integers(0, 3))) for i in range(160)]
    rows += [(200 + i, rows[i][1], i % 3) for i in range(20)]  # ties
    rows += [(300, None, 1), (305, [float("nan")] * 6, 1), (310, [None] + [1.0] * 5, 1), (315, [float("inf")] * 6, 1),
             (320, [1.0] * 6, None), (None, [1.0] * 6, 1), (325, [], 2), (330, [1.0, 2.0], 2), (335, [1000.0] * 6, 0)]
    want = brute(rows)
    assert len(want) > 300 and got(spark, rows) == want


def test_one_label_holds_a_third_and_rows_repeat(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else (rnd.normal(size=3) + 2).tolist(), 7 if i % 3 == 0 else i % 4) for i in range(120)]
    assert got(spark, rows) == brute(rows)
    twice = rows + rows[50:60]  # an anchor's row twice gives its results twice
    assert got(spark, twice) == brute(twice)


def test_no_rows_no_positives_no_window(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-1.0], 2)]) == []  # a negative score has an empty window


@pytest.mark.parametrize("dims,size", [(1, 10), (64, 200), (65, 5000), (300, 10 ** 6), (7, 10 ** 8), (64, 2 ** 28)])
def test_residue_product_is_exact(dims, size):
    rnd = np.random.default_rng(dims)
    a, b = rnd.integers(-size, size + 1, (40, dims)), rnd.integers(-size, size + 1, (50, dims))
    a[0], b[0], b[1] = size, size, -size  # the extremes
    want = a.astype(object) @ b.T.astype(object)
    s = N.scores(N.Residues(a), N.Residues(b))
    assert s.dtype == np.int64 and (s.astype(object) == want).all()
    assert (N.scores(N.Residues(a), N.Residues(b), slice(3, 9)).astype(object) == want[3:9]).all()


def test_partial_sums_stay_exact_in_float32():
    """The largest residues, WIDTH of them, stay below 2^24; the primes differ and cover 64 bits."""
    assert N.WIDTH * (max(N.PRIMES) // 2) ** 2 < 2 ** 24
    assert all(math.gcd(p, q) == 1 for p in N.PRIMES for q in N.PRIMES if p != q) and math.prod(N.PRIMES) > 2 ** 64
    with pytest.raises(OverflowError):
        N.scores(N.Residues(np.full((1, 4), 2 ** 40)), N.Residues(np.full((1, 4), 2 ** 40)))


def test_first_of_keeps_ties_by_id():
    score, ids = np.array([5, 9, 9, 9, 1] * 20), np.arange(100)[::-1]
    rows = np.arange(100)
    want = sorted(rows, key=lambda r: (-score[r], ids[r]))[:7]
    assert N.first_of(score, ids, rows, 7).tolist() == want
