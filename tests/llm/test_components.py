import random

import pytest

from sweepframe.llm.components import components


def brute(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return {x: root(x) for x in parent}


def graphs():
    rnd = random.Random(1)
    yield []
    yield [(1, 1)]
    yield [(i, i + 1) for i in range(200)]
    yield [(0, i) for i in range(1, 300)]
    yield [(i, 500) for i in range(1, 300)] + [(500, 501), (700, 701)]
    yield [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]


@pytest.mark.parametrize("links", list(graphs()), ids=range(6))
def test_components(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    rows = components(spark, df).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.comp for r in rows} == brute(links)
