"""Toxicity: cumulative-link ordinal regression over sparse text features.

Features are counts of words chosen from a bounded labelled sample by how
unevenly they occur in toxic and other texts.  Severity grades: 0 for texts
not marked toxic; marked texts are graded by how many of their words are
markers (words far more usual in marked texts), cut at ``GRADES``.  One
weight vector serves all thresholds: ``P(grade >= k) = s(w.x - cut_k)``,
with rising cuts, so severity is the sum of these probabilities.

Defined results: null or empty text has no features; rows are independent;
other columns pass through ``score``; without both kinds of labels nothing
is a feature, and all texts get the smoothed share of marked ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sweepframe.llm import textcore as tc
from sweepframe.llm.common import arrow_batches, fresh, written
from sweepframe.llm.labelled import SAMPLE, labelled_texts

#: Words that are features, at most.
FEATURES = 512
#: Least number of sampled texts that hold a feature, and its least test statistic (G, one degree of freedom).
MIN_TEXTS, MIN_G = 5, 15.0
#: A marker is this many times as usual in marked texts.
MARKER_RATIO = 8.0
#: Marker words in a marked text from which its grade is 1, 2, 3.
GRADES = (0, 2, 4)
#: Counts above this add nothing.
MOST = 5
STEPS, RATE, RIDGE = 400, 0.05, 1e-5


@dataclass
class Ordinal:
    """Word hashes (ascending) with their weights, and the cuts between grades."""

    words: np.ndarray
    weight: np.ndarray
    cuts: np.ndarray

    def at_least(self, linear: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for each text and grade above 0."""
        return 1 / (1 + np.exp(-(linear[:, None] - self.cuts[None, :])))

    def linear(self, w: tc.Words) -> np.ndarray:
        text, word, count = counted(w, self.words)
        return np.bincount(text, np.minimum(count, MOST) * self.weight[word], len(w.first) - 1)


def counted(w: tc.Words, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse counts ``(text, feature, times)`` of the known words."""
    if not len(known) or not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = w.hashes()
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = np.flatnonzero(known[at] == h)
    key, times = np.unique(w.doc()[hit] * len(known) + at[hit], return_counts=True)
    return key // len(known), key % len(known), times


def _word_counts(texts: DataFrame) -> DataFrame:
    """``doc_id, label, word, times`` of the sampled texts, words as hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tc.chunks(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                w = tc.words(part.column(1), tc.ALNUM)
                h, doc = w.hashes(), w.doc()
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                edge = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
                times = np.diff(np.r_[edge, len(h)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc[edge])), part.column(2).take(pa.array(doc[edge])),
                     pa.array(h[edge].view(np.int64)), pa.array(times, pa.int64())], names=["doc_id", "label", "word", "times"])

    return texts.mapInArrow(task, "doc_id long, label int, word long, times long")


def g_statistic(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Likelihood-ratio statistic of a word in ``a`` of ``n1`` marked and ``b`` of ``n0`` other texts."""
    share = (a + b) / (n1 + n0)

    def part(seen, want):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(want, 1e-12)), 0.0)

    return 2 * (part(a, n1 * share) + part(n1 - a, n1 * (1 - share)) + part(b, n0 * share) + part(n0 - b, n0 * (1 - share)))


def fit(x: np.ndarray, grade: np.ndarray, n_cuts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and rising cuts for dense features."""
    row, col = np.nonzero(x)
    return fit_sparse(row, col, x[row, col].astype(float), x.shape[1], grade, n_cuts)


def fit_sparse(row: np.ndarray, col: np.ndarray, value: np.ndarray, k: int, grade: np.ndarray,
               n_cuts: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared weights and rising cuts by Adam on the cumulative-link likelihood; features as (row, column, value)."""
    n = len(grade)
    above = (grade[:, None] >= np.arange(1, n_cuts + 1)[None, :]).astype(float)
    share = (above.sum(0) + 0.5) / (n + 1)
    first = np.log((1 - share) / share)
    # cuts are the first one and positive steps, held as logarithms
    free = np.r_[np.zeros(k), first[0], np.log(np.maximum(np.diff(first), 0.05))]
    m, v = np.zeros_like(free), np.zeros_like(free)
    for t in range(1, STEPS + 1):
        steps = np.exp(free[k + 1:])
        cuts = free[k] + np.r_[0, np.cumsum(steps)]
        linear = np.bincount(row, value * free[col], n)
        p = 1 / (1 + np.exp(-linear[:, None] + cuts[None, :]))
        err = (p - above) / n
        by_cut = -err.sum(0)
        by_weight = np.bincount(col, value * err.sum(1)[row], k)
        grad = np.r_[by_weight + RIDGE * free[:k], by_cut.sum(), np.cumsum(by_cut[::-1])[::-1][1:] * steps]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        free = free - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return free[:k], free[k] + np.r_[0, np.cumsum(np.exp(free[k + 1:]))]


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "toxic", rows: int = SAMPLE) -> Ordinal:
    """Choose features and fit; at most ``rows`` texts with ``FEATURES`` counts each reach the driver, sparse."""
    arrow_batches(spark)
    texts = labelled_texts(docs, labels, column, rows)
    sizes = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sum(n for k, n in sizes.items() if k != 1)
    share = (n1 + 1) / (n1 + n0 + 2)
    flat = Ordinal(np.zeros(0, np.uint64), np.zeros(0), np.log((1 - share) / share) + np.arange(len(GRADES), dtype=float))
    if not n1 or not n0:
        return flat
    counts = written(spark, _word_counts(texts), "toxic_counts")
    held = (counts.groupBy("word").agg(F.sum((F.col("label") == 1).cast("long")).alias("a"),
                                       F.sum((F.col("label") != 1).cast("long")).alias("b"))
            .where(F.col("a") + F.col("b") >= MIN_TEXTS))
    # the statistic in SQL, so that only the best words reach the driver
    p = (F.col("a") + F.col("b")) / F.lit(n1 + n0)

    def part(seen, want):
        return F.when(seen > 0, seen * F.log(seen / want)).otherwise(0.0)

    g = 2 * (part(F.col("a"), n1 * p) + part(n1 - F.col("a"), n1 * (1 - p))
             + part(F.col("b"), n0 * p) + part(n0 - F.col("b"), n0 * (1 - p)))
    best = held.withColumn("g", g).where(F.col("g") >= MIN_G).orderBy(F.desc("g"), "word").limit(FEATURES).toPandas()
    if not len(best):
        return flat
    word = best["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(word)
    word = word[order]
    a, b = best["a"].to_numpy(float)[order], best["b"].to_numpy(float)[order]
    marker = (a / n1) >= MARKER_RATIO * (b + 0.5) / n0
    chosen = F.broadcast(best[["word"]].pipe(spark.createDataFrame))
    few = counts.join(chosen, "word").select("doc_id", "label", "word", "times").toPandas()
    every = texts.select("doc_id", "label").orderBy("doc_id").toPandas()  # one row an id, at most ``rows``
    ids, label = every["doc_id"].to_numpy(), every["label"].to_numpy()
    row = np.searchsorted(ids, few["doc_id"].to_numpy())
    col = np.searchsorted(word, few["word"].to_numpy(np.int64).view(np.uint64))
    value = np.minimum(few["times"].to_numpy(), MOST).astype(float)
    marks = np.bincount(row, value * marker[col], len(ids))
    grade = np.where(label == 1, 1 + (marks[:, None] >= np.array(GRADES[1:])[None, :]).sum(1), 0)
    weight, cuts = fit_sparse(row, col, value, len(word), grade, len(GRADES))
    return Ordinal(word, weight, cuts)


FIELDS = [("score", T.DoubleType()), ("expected_severity", T.DoubleType()), ("grade", T.IntegerType())]


def score(spark: SparkSession, docs: DataFrame, model: Ordinal) -> DataFrame:
    """``docs`` with ``score`` (probability of any grade above 0), ``expected_severity`` and the likeliest ``grade``; no shuffle."""
    arrow_batches(spark)
    known = spark.sparkContext.broadcast(model)
    names, at = docs.columns, docs.columns.index("text")
    new = [fresh(docs, n) for n, _ in FIELDS]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            linear = [known.value.linear(tc.words(column.slice(lo, hi - lo), tc.ALNUM)) for lo, hi in tc.chunks(column)]
            above = known.value.at_least(np.concatenate(linear) if linear else np.zeros(0))
            each = -np.diff(np.column_stack([np.ones(len(above)), above, np.zeros(len(above))]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(above[:, 0]), pa.array(above.sum(1)), pa.array(each.argmax(1), pa.int32())],
                names=[*names, *new])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, (_, k) in zip(new, FIELDS)]]))
