import random
import re

import numpy as np
import pytest
from helpers import awkward, docs, stored

from sweepframe.llm import mixing as M


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes):
    """Reshare the excess over three times a source's size until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(w[s] for s in names if s not in capped)
        t = {s: 3.0 * sizes[s] if s in capped else rest * w[s] / free for s in names}
        over = {s for s in names if s not in capped and t[s] > 3 * sizes[s]}
        if not over:
            return t
        capped |= over


def corpus(seed, n=600):
    rnd = random.Random(seed)
    return [(i, " ".join("w" for _ in range(int(rnd.paretovariate(1.1) * 5) % 900)),
             None if i % 50 == 49 else f"s{min(9, int(rnd.expovariate(0.5)))}") for i in range(n)]


def by_source(rows, got):
    out = {}
    for (i, t, s) in rows:
        out.setdefault(s, []).append(got[i])
    return out


@pytest.mark.parametrize("block", [4096, 64])
def test_targets_and_totals(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rows = corpus(1)
    got = {r.doc_id: r for r in M.mix_report(spark, docs(spark, rows)).collect()}
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    for s, rs in by_source(rows, got).items():
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 for r in rs)
        assert abs(sum(r.taken for r in rs) - want[s]) <= 0.03 * want[s] + 5
    for i, t, _ in rows:
        assert got[i]["size"] == size(t) and 0 <= got[i].taken <= 3 * size(t)


def test_reruns_agree_whatever_the_layout(spark):
    rows = corpus(2, 200)
    a, b = (sorted(tuple(r) for r in M.mix_report(spark, docs(spark, x).repartition(n)).collect())
            for x, n in ((rows, 2), (rows[::-1], 5)))
    assert a == b


def test_flight_keeps_totals():
    rnd = np.random.default_rng(0)
    for seed in range(20):
        s = rnd.integers(0, 50, 300)
        pi = np.full(300, 0.37)
        p = M.flight(pi, s, np.random.default_rng(seed), False)
        undecided = (p > 0) & (p < 1)
        assert undecided.sum() <= 2 + len(M.CHANGE)
        assert abs(p.sum() - pi.sum()) < 1e-6 and abs(p @ s - pi @ s) < 1e-5
        landed = M.flight(pi, np.sort(s)[::-1], np.random.default_rng(seed), True)
        assert set(landed) <= {0.0, 1.0} and abs(landed @ np.sort(s)[::-1] - pi @ s) <= 2


def test_awkward_rows(spark, tmp):
    rows = [(i, t, ["a", None, "b", ""][i % 4]) for i, t in awkward()] + [(None, "x y", "a"), (7, "x y", "a"), (7, "x y", "a"), (900, "", "empty")]
    d = stored(spark, docs(spark, rows, extra=True), tmp)
    report = M.mix_report(spark, d).collect()
    assert len(report) == len(rows)
    assert [r.taken for r in report if r.doc_id == 900] == [0]
    out = M.mix(spark, d)
    assert out.columns == d.columns
    mixed = out.collect()
    assert sum(size(r.text) for r in mixed) == sum(r.taken for r in report)


def test_empty_and_wordless(spark):
    assert M.mix_report(spark, docs(spark, [])).count() == 0
    assert [r.target for r in M.mix_report(spark, docs(spark, [(1, ""), (2, None)])).collect()] == [0.0, 0.0]


def test_repeated_rows_are_dealt_over_blocks(spark, monkeypatch):
    """Rows alike in all columns do not stand in one block, and the mix is the same in any layout."""
    fly = M.flight

    def bounded(pi, size, draw, land):
        assert len(pi) <= 192, len(pi)
        return fly(pi, size, draw, land)

    monkeypatch.setattr(M, "BLOCK", 64)
    monkeypatch.setattr(M, "flight", bounded)
    rows = corpus(3, 300) + [(7000, "w w w w w", "s0")] * 600
    found = []
    for parts in (1, 5):
        d = docs(spark, rows).repartition(parts)
        found.append(sorted((r.doc_id, r.taken, r.source_size, r.target) for r in M.mix_report(spark, d).collect()))
    assert len(found[0]) == len(rows) and found[0] == found[1]
    of = {}
    for (i, t, s) in rows:
        of[i] = s
    want = {of[i]: t for i, _, _, t in found[0]}
    for s, target in want.items():
        assert abs(sum(x for i, x, _, _ in found[0] if of[i] == s) - target) <= 0.03 * target + 5
