import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from sweepframe.llm import conversation_trie as C
from sweepframe.llm.queries import op13_conversation_trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                       T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("k", T.StringType())])
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts, key=lambda t: t[0])] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + ts[h:]
    return out


def brute(seqs):
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = collections.Counter(key[:-1] for key in members if key)
    leaves, saved = collections.Counter(), collections.Counter()
    for key, ms in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(ms) - 1) * len(key[-1][1]) if key else 0
    out = []
    for key, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(seqs[c]) == len(key))))
        out.append((min(ms), len(key), min(members[key[:-1]]) if key else None, len(ms), children[key], leaves[key], saved[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows, tmp):
    spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).write.parquet(f"{tmp}/conversations.parquet")
    return tmp


def found(df):
    assert df.columns == COLS
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, convs=260, longest=40):
    """Shared heads, copies, turns missing and repeated, some long conversations."""
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        n = rnd.choice([1, 2, 3, 5, 8, rnd.randrange(1, longest)])
        same = c % 3 == 0  # a third are copies
        for t in range(n if not same else 7):
            text = "copy" if same else rnd.choice(["a", "b", "çé", ""]) * (1 + t % 3)
            rows.append((c * 3 if c % 7 else c * 3 + 1000, t, rnd.choice(["user", "assistant"]) if not same else "user", text))
    rows += [(5, None, "user", "first"), (5, None, "user", "first"), (None, 1, "user", "x"), (7000, 0, None, None), (7010, 0, "", ""),
             (-5, 0, "user", "neg"), (-5, 1, "user", "neg2"), (-5, 2, "user", "neg3")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,shard,path,span", [(32, 50_000, 8, 1024), (4, 17, 2, 2), (3, 5, 1, 3)])
def test_query_against_brute_force(spark, tmp, monkeypatch, width, shard, path, span):
    for name, v in (("WIDTH", width), ("SHARD", shard), ("PATH", path), ("SPAN", span)):
        monkeypatch.setattr(C, name, v)
    rows = corpus(width)
    got = found(op13_conversation_trie(spark, table(spark, rows, tmp)))
    want = brute(rebuild(rows))
    assert len(want) > 300 and got == want


def test_without_rebuilding(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD", 20)
    rows = corpus(1, 80)
    seqs = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            seqs[c].append((role or "", text or ""))
    assert found(C.trie(spark, spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA))) == brute(seqs)


def test_turnless_single_and_empty(spark, tmp_path):
    for i, rows in enumerate([[], [(150, 0, "user", "gone")], [(100 * i, 0, "user", "same") for i in range(40)]]):
        got = found(op13_conversation_trie(spark, table(spark, rows, f"{tmp_path}/{i}")))
        assert got == brute(rebuild(rows))


def test_one_conversation_holds_a_third(spark, tmp, monkeypatch):
    monkeypatch.setattr(C, "SPAN", 4)
    rnd = random.Random(3)
    rows = [(200, t, "user", str(t % 50)) for t in range(700)] + [(201, t, "user", str(t % 50)) for t in range(690)]
    rows += [(c, t, "user", str(rnd.randrange(3))) for c in range(300, 500) for t in range(5)]
    assert found(op13_conversation_trie(spark, table(spark, rows, tmp))) == brute(rebuild(rows))
