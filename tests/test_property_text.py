"""Path helpers (G15) and header pairs (S8) against Python's own semantics, on random inputs."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sweepframe.functions.records import header_record
from sweepframe.operators import render as G

SEG = st.text(alphabet="ab.-_", min_size=0, max_size=5)
PATH = st.builds(lambda lead, segs: ("/" if lead else "") + "/".join(segs), st.booleans(), st.lists(SEG, max_size=4))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(PATH, PATH), min_size=1, max_size=40))
def test_path_helpers_match_os_path(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(G.path_join(F.col("a"), F.col("b")).alias("j"), G.basename(F.col("b")).alias("n"),
                    G.extension(F.col("b")).alias("e")).collect()
    for (a, b), r in zip(pairs, got):
        assert r.j == os.path.join(a, b)
        assert r.n == os.path.basename(b)
        assert r.e == os.path.splitext(b)[1]


KEY = st.text(alphabet="abc", min_size=1, max_size=3)
VAL = st.text(alphabet="xy=", min_size=0, max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(KEY, VAL), min_size=1, max_size=5), min_size=1, max_size=20))
def test_header_pairs_match_dict_semantics(spark, rows):
    kvs = [",".join(f"{k}={v}" for k, v in r) for r in rows]
    df = spark.createDataFrame([(s,) for s in kvs], "kvs string")
    got = df.select(header_record(F.create_map(F.lit("USER"), F.lit("u")), F.col("kvs")).alias("m")).collect()
    for s, r in zip(kvs, got):
        want = {"USER": "u"}
        for pair in s.split(","):
            kv = pair.split("=")
            want[kv[0]] = kv[1]  # a value stops at a second '='; later keys win
        assert dict(r.m) == want


JKEY = st.text(alphabet="abc._", min_size=1, max_size=6)
JVAL = st.one_of(
    st.integers(-10**6, 10**6),
    st.floats(allow_nan=False, allow_infinity=False, width=64),
    st.lists(st.floats(allow_nan=False, allow_infinity=False), max_size=4),
    st.text(alphabet="xyz ,:", max_size=5),
    st.booleans())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(JKEY, JVAL, min_size=1, max_size=6), min_size=1, max_size=20))
def test_raw_json_map_matches_json(spark, objs):
    import json

    from sweepframe.sources.text import raw_json_map

    lines = [json.dumps(o) for o in objs]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select(
        raw_json_map(F.col("line")).alias("m")).select("m", F.map_keys("m").alias("k")).collect()
    for o, r in zip(objs, got):
        m = dict(r.m)
        assert r.k == list(o)  # keys in line order (kept inside Spark)
        # each value keeps its exact text: parsing it gives the original value back
        assert {k: json.loads(v) for k, v in m.items()} == o
