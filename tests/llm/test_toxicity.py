import numpy as np
import pyarrow as pa
from helpers import awkward, docs, sentence
import random

from pyspark.sql import functions as F

from sweepframe.llm import textcore as tc
from sweepframe.llm import toxicity as X
from sweepframe.llm.labelled import held_out


def test_sparse_counts_against_brute_force():
    known = np.sort(np.array([tc.hash_word(w) for w in ("bad", "worse", "é")], np.uint64))
    back = {tc.hash_word(w): w for w in ("bad", "worse", "é")}
    texts = ["Bad, bad!BAD worse", "", None, "good", "badly é É"]
    got = {(t, back[int(known[w])]): n for t, w, n in zip(*X.counted(tc.words(pa.array(texts), tc.ALNUM), known))}
    assert got == {(0, "bad"): 3, (0, "worse"): 1, (4, "é"): 1}


def test_ordinal_fit_shares_weights_and_orders_cuts():
    rnd = np.random.default_rng(0)
    x = rnd.integers(0, 4, (4000, 3)).astype(float)
    grade = np.clip(np.round(x[:, 0] - 0.5 * x[:, 1] + rnd.normal(0, 0.4, 4000)), 0, 3)
    w, cuts = X.fit(x, grade, 3)
    assert (np.diff(cuts) > 0).all() and w[0] > 0 > w[1] and abs(w[2]) < 0.2 * w[0]
    model = X.Ordinal(np.zeros(0, np.uint64), w, cuts)
    above = model.at_least(x @ w)
    assert (np.diff(above, axis=1) <= 0).all()
    assert np.corrcoef(above.sum(1), grade)[0, 1] > 0.85


def test_g_statistic_finds_uneven_words():
    g = X.g_statistic(np.array([50., 10, 5]), np.array([0., 90, 45]), 100, 900)
    assert g[0] > 200 and g[1] < 1 and g[2] < 1


def test_held_out_rows(spark):
    rnd = random.Random(0)
    rows, labels = [], []
    for i in range(900):
        words = sentence(rnd, rnd.randrange(5, 200)).split()
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randrange(1, 6)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["scum,", "Idiot", "vile!", "trash."]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    d, lab = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = X.score(spark, d, X.train(spark, d, lab)).join(lab, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in got]) > 0.97
    severe = [r.expected_severity for r in got if len([w for w in r.text.split() if not w.startswith("w")]) >= 4]
    mild = [r.expected_severity for r in got if r.toxic and len([w for w in r.text.split() if not w.startswith("w")]) == 1]
    assert np.mean(severe) > np.mean(mild) + 0.5
    assert all(0 <= r.score <= 1 and 0 <= r.expected_severity <= 3 and 0 <= r.grade <= 3 for r in got)


def test_awkward_rows(spark):
    d = docs(spark, awkward(), extra=True)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = X.score(spark, d, X.train(spark, d, none)).collect()
    assert len(out) == d.count() and len({r.expected_severity for r in out}) == 1
    assert X.score(spark, docs(spark, []), X.train(spark, d, none)).count() == 0


def test_repeated_rows_change_nothing(spark):
    """Documents that stand four times, some with another text, are one training row each, never more than the bound."""
    rnd = random.Random(3)
    rows = [(i, sentence(rnd, 30) + (" scum vile" if i % 5 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] * 2, "doc_id long, toxic int")
    once = X.train(spark, docs(spark, rows), labels)
    many = X.train(spark, docs(spark, rows * 4 + [(7, "zzz"), (7, None), (None, "scum")]), labels)
    assert len(once.words) and np.array_equal(once.words, many.words) and np.allclose(once.weight, many.weight) and np.allclose(once.cuts, many.cuts)
    bounded = X.train(spark, docs(spark, rows * 4), labels, rows=60)
    assert len(bounded.cuts) == len(X.GRADES)
