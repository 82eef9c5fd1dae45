"""The exact median by selection against a sort in Python, and its plan."""

import random
import statistics

import pytest

from sweepframe.operators import stats as S


@pytest.mark.parametrize("ranges,steps", [(4096, 2), (2, 1), (3, 4), (1, 0)])
def test_median_of_uneven_values(spark, monkeypatch, ranges, steps):
    """Ties, even and odd counts, one value, values of very different size, nulls; few ranges leave the rest to ranks."""
    monkeypatch.setattr(S, "RANGES", ranges)
    monkeypatch.setattr(S, "NARROWINGS", steps)
    rnd = random.Random(11)
    kinds = [lambda: rnd.random() * 1e-9, lambda: rnd.randint(-4, 30) / 2, lambda: -rnd.random() * 1e12]
    values = {g: [rnd.choice(kinds)() for _ in range(n)] for g, n in (("a", 301), ("b", 400), ("c", 1), ("d", 2))}
    values["same"] = [5.0] * 90
    rows = [(g, x) for g, xs in values.items() for x in xs] + [("a", None), ("none", None)]
    got = {r.g: r.median for r in S.exact_median(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert got == {g: statistics.median(xs) for g, xs in values.items()}


def test_summary_runs_nothing_before_it_is_asked(spark):
    t = spark.createDataFrame([("f", 1.0, 2.0, False), ("g", None, 4.0, False), ("h", 9.0, 9.0, True)],
                              "file string, setup double, sim double, early boolean")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("median_plan", "plan only")
    try:
        out = S.timing_summary(t)
        assert list(tracker.getJobIdsForGroup("median_plan")) == []
        got = {r.series: (r.n, r.median, r.total) for r in out.collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {"SETUP": (1, 1.0, 1.0), "SIM": (2, 3.0, 6.0), "TOTAL": (1, 3.0, 3.0)}
