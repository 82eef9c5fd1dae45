import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, docs, sentence, stored

from sweepframe.llm import ngram_join as J
from sweepframe.llm import textcore as tc


def shingle_set(text, n):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, n, percent):
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return sorted((i, len(s), root(i)) for i, s in sets)


def got(spark, rows, n, percent):
    return sorted(tuple(r) for r in J.report(spark, docs(spark, rows), n, percent).collect())


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50)])
def test_against_brute_force(spark, n, percent):
    rows = awkward(n)
    assert got(spark, rows, n, percent) == brute(rows, n, percent)


def test_shared_passage_and_chains(spark):
    """Documents that share a long passage, chains of edits, and short documents with ties."""
    rnd = random.Random(5)
    passage = sentence(rnd, 80)
    rows = [(i, passage + " " + sentence(rnd, 20, 10 ** 6)) for i in range(40)]
    w = sentence(rnd, 200, 10 ** 6).split()
    for k in range(25):  # each differs from the one before in one word
        w = list(w)
        w[(7 * k) % len(w)] = f"edit{k}"
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + i, " ".join(rnd.choice("ab") for _ in range(rnd.randrange(1, 6)))) for i in range(60)]
    rnd.shuffle(rows)
    for n, percent in ((3, 90), (5, 80)):
        assert got(spark, rows, n, percent) == brute(rows, n, percent)


def test_large_group_makes_few_pairs(spark):
    """Near copies are linked through pivots: verified pairs stay near the group's size."""
    rnd = random.Random(8)
    base = sentence(rnd, 300, 10 ** 6).split()
    rows = []
    for k in range(200):
        w = list(base)
        w[rnd.randrange(300)] = f"edit{k}"
        rows.append((k, " ".join(w)))
    seen = []
    verify = J._verify

    def counting(spark, d, pairs, n, percent):
        seen.append(pairs.count())
        return verify(spark, d, pairs, n, percent)

    J._verify = counting
    try:
        out = got(spark, rows, 3, 90)
    finally:
        J._verify = verify
    assert {c for _, _, c in out} == {0}
    assert sum(seen) < 200 * 20


def test_prefix_lemma():
    """Similar sets share ``m`` shingles within their prefixes, whatever the counts say."""
    rnd = np.random.default_rng(3)
    for _ in range(300):
        base = np.sort(rnd.choice(10 ** 6, 60, replace=False)).astype(np.uint64)
        other = np.sort(np.r_[np.delete(base, rnd.choice(60, 3, replace=False)), rnd.choice(10 ** 6, 2).astype(np.uint64) + 10 ** 6])
        weight = lambda t: np.where(t % 7 == 0, (t % 50).astype(np.int64) + 1, 0)
        shared = len(np.intersect1d(base, other))
        if 100 * shared < 80 * (len(base) + len(other) - shared):
            continue
        (p, m), (q, k) = (J.prefix(t, weight(t), 80) for t in (base, other))
        least = min(m, k)
        cut = [t[:len(t) - (m_ - least)] for t, m_ in ((p, m), (q, k))]
        assert len(np.intersect1d(*cut)) >= least


def test_parity_bitmaps_bound_the_difference(spark):
    """Bits that differ, after folding to one length, never outnumber the shingles that differ."""
    rnd = np.random.default_rng(4)
    for n in (3, 100, 1500, 5000):
        x = np.unique(rnd.integers(0, 1 << 62, n, dtype=np.uint64))
        y = np.unique(np.r_[x[n // 9:], rnd.integers(0, 1 << 62, n // 7, dtype=np.uint64)])
        both = J.parity(np.r_[x, y], np.array([0, len(x), len(x) + len(y)])).to_pylist()
        df = spark.createDataFrame([tuple(both)], "x array<long>, y array<long>")
        fold = lambda c, o: J.F.when(J.F.size(c) > J.F.size(o), J._halved(J.F.col(c))).otherwise(J.F.col(c))
        p, q = df.select(fold("x", "y"), fold("y", "x")).first()
        assert len(p) == len(q)
        flipped = sum(bin((a ^ b) & (2 ** 64 - 1)).count("1") for a, b in zip(p, q))
        assert flipped <= len(np.setxor1d(x, y)) and (n < 100 or flipped)


def test_stage(spark, tmp):
    d = stored(spark, docs(spark, awkward(), extra=True), tmp)
    out = J.deduplicate(spark, d)
    assert out.columns == d.columns
    want = brute(awkward(), 5, 80)
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, n, c in want if i == c or n == 0)


def test_empty(spark):
    assert got(spark, [], 3, 90) == []
    assert got(spark, [(1, None), (2, "")], 3, 90) == [(1, 0, 1), (2, 0, 2)]
    assert J.deduplicate(spark, docs(spark, [])).count() == 0


def test_words_and_shingles():
    texts = ["A b\tC", "", None, "É é", "x" * 500 + " y", "a b c d a b c"]
    w = tc.words(pa.array(texts), tc.SPACED)
    spans = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end)]
    assert spans == [x.decode() for t in texts for x in (t or "").encode().lower().split()]
    for n in (1, 2, 3):
        tokens, off = tc.shingles(w, n)
        assert np.diff(off).tolist() == [len(shingle_set(t, n)) for t in texts]


def test_long_words_hash_alike_in_any_chunk():
    """A word's hash depends on its bytes alone, not on how many other long words stand beside it."""
    rnd = random.Random(6)
    long = ["".join(rnd.choice("abcdef") for _ in range(n)) for n in (63, 64, 65, 66, 100, 300, 4159, 4160, 4161, 9000)]
    many = [chr(97 + i % 26) * 9500 + str(i) for i in range(100)]
    alone = [int(tc.words(pa.array([t]), tc.SPACED).hashes()[0]) for t in long]
    few = tc.words(pa.array(long), tc.SPACED).hashes()
    crowd = tc.words(pa.array(long + many), tc.SPACED).hashes()
    assert few.tolist() == alone and crowd[:len(long)].tolist() == alone
    assert len(set(crowd.tolist())) == len(crowd)
    assert tc.hash_word(long[-1], tc.SPACED) == alone[-1]


def test_nul_is_part_of_a_word():
    """Only white space parts words; a NUL byte is a byte like others."""
    w = tc.words(pa.array(["a\0b c", "ab c", "a b c"]), tc.SPACED)
    assert w.counts.tolist() == [2, 2, 3] and len(set(w.hashes().tolist())) == 5
    assert tc.words(pa.array(["a\0b"]), tc.ALNUM).counts.tolist() == [2]


def test_copies_of_long_words_link(spark):
    """Copies and near copies whose words are long link, whatever else is in their chunks."""
    rnd = random.Random(7)
    texts = [" ".join("".join(rnd.choice("abc") for _ in range(90)) for _ in range(30)) for _ in range(6)]
    near = [" ".join([*t.split()[:-1], "end"]) for t in texts]
    filler = " ".join("".join(rnd.choice("xyz") for _ in range(200)) for _ in range(5500))  # a chunk of its own
    rows = [(i, t) for i, t in enumerate(texts[:1] + [filler] + texts[1:] + texts + near)]
    assert got(spark, rows, 3, 80) == brute(rows, 3, 80)


def test_null_ids_stay_and_link_with_copies_only(spark, tmp):
    rnd = random.Random(9)
    base = sentence(rnd, 200).split()
    near = [" ".join([*base[:100 + i], f"x{i}", *base[101 + i:]]) for i in range(4)]
    rows = [(7, near[0]), (None, near[0]), (None, near[1]), (None, sentence(rnd, 60)), (None, sentence(rnd, 70)), (8, near[2])]
    got = sorted(((-1 if i is None else i), -1 if c is None else c) for i, _, c in J.report(spark, docs(spark, rows), 3, 90).collect())
    assert got == [(-1, -1), (-1, -1), (-1, -1), (-1, 7), (7, 7), (8, 7)]
    kept = J.deduplicate(spark, stored(spark, docs(spark, rows), tmp))
    assert sorted(r.text for r in kept.collect()) == sorted([near[0], near[1], rows[3][1], rows[4][1]])


def test_profile_task_memory_is_bounded():
    """The first pass holds little beside a chunk, however much text a task has."""
    import tracemalloc

    rnd = random.Random(1)
    texts = [sentence(rnd, 3000, 10 ** 6) for _ in range(60)]

    class Taken:
        def select(self, *_):
            return self

        def mapInArrow(self, task, _):
            self.task = task

    taken = Taken()
    J._profiles(taken, 3)

    def batches(n):
        ids = pa.array(range(60), pa.int64())
        for _ in range(n):
            yield pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["rid", "doc_id", "text"])

    peaks = []
    for n in (2, 12):
        tracemalloc.start()
        for _ in taken.task(batches(n)):
            pass
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert peaks[1] < 120 and peaks[1] < 1.3 * peaks[0]
