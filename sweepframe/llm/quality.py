"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed with numpy per chunk of text.
The trees are fitted on the driver from a bounded labelled sample
(``labelled.SAMPLE`` rows of ``len(STATISTICS)`` numbers): each statistic is
cut into ``BINS`` quantile bins, and a level's splits come from histograms
of gradients.  The trees are complete, so a forest is three arrays, and
scoring walks all rows of a batch down one level at a time.

Defined results: null text is empty and scored like any other (all its
statistics are 0); other columns pass through ``score``; without usable
labels the score is 0.5, with labels of one kind their smoothed mean.
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
from sweepframe.llm.common import arrow_batches, fresh
from sweepframe.llm.labelled import SAMPLE, labelled_texts

BINS = 64
DEPTH = 4
TREES = 60
RATE = 0.2
#: Regularisation of leaf values, and the least hessian of a leaf.
RIDGE, LEAST = 1.0, 4.0

STATISTICS = [
    "log_words", "log_bytes", "word_bytes", "long_words", "upper", "digits", "non_ascii", "spaces", "newlines", "punctuation",
    "odd_signs", "exclaims", "bars", "stops", "repeats", "distinct", "top_word", "signed_ends", "letterless", "upper_words",
    "capital_words", "run_signs", "line_words",
]

_BYTES = np.arange(256)


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER, _DIGIT = (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 48) & (_BYTES <= 57)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT
_PLAIN = _is(".,;:'\"()-?!")


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text of a chunk."""
    raw, off = tc.raw_bytes(column)
    w = tc.words(column, tc.SPACED)
    n = len(off) - 1

    def per_text(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flag)][off]).astype(float)

    def per_word(flag: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(flag)][w.first]).astype(float)

    size, count = np.diff(off).astype(float), w.counts.astype(float)
    per_byte, each = 1 / np.maximum(size, 1), 1 / np.maximum(count, 1)
    length = w.end - w.start
    hashes, doc = w.hashes(), w.doc()
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    distinct, top = np.zeros(n), np.zeros(n)
    for t, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist())):
        if b > a:
            h = np.sort(hashes[a:b])
            edge = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True])
            distinct[t], top[t] = len(edge) - 1, np.diff(edge).max()
    up, sign, letter = np.cumsum(np.r_[0, _UPPER[raw]]), _SIGN[raw], np.cumsum(np.r_[0, _LETTER[raw]])
    letters = letter[w.end] - letter[w.start]
    uppers = up[w.end] - up[w.start]
    last = raw[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    first = raw[w.start] if len(w.start) else np.zeros(0, np.uint8)
    double = np.r_[False, sign[1:] & (raw[1:] == raw[:-1])] if len(raw) else sign
    lines = per_text(raw == 10) + 1
    return np.column_stack([
        np.log1p(count), np.log1p(size), per_word_sum(length, w.first) * each, per_word(length > 15) * each,
        per_text(_UPPER[raw]) * per_byte, per_text(_DIGIT[raw]) * per_byte, per_text(raw >= 128) * per_byte,
        per_text(raw == 32) * per_byte, per_text(raw == 10) * per_byte, per_text(sign & _PLAIN[raw]) * per_byte,
        per_text(sign & ~_PLAIN[raw]) * per_byte, per_text(raw == 33) * each, per_text(raw == 124) * each,
        per_text(raw == 46) * each, per_word(again) * each, distinct * each, top * each,
        per_word(_SIGN[last] & ~_PLAIN[last]) * each, per_word(letters == 0) * each,
        per_word((uppers > 1) & (uppers * 2 >= letters)) * each, per_word(_UPPER[first]) * each,
        per_text(double) * each, np.log1p(count / lines),
    ])


def per_word_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][first]).astype(float)


def batch_statistics(column: pa.Array) -> np.ndarray:
    parts = [statistics(column.slice(lo, hi - lo)) for lo, hi in tc.chunks(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(STATISTICS)))


@dataclass
class Forest:
    """Complete trees as arrays: ``split`` and ``cut`` per inner node, ``leaf`` per leaf, tree by tree."""

    split: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        row = np.arange(len(x))
        inner = self.split.shape[1]
        for split, cut, leaf in zip(self.split, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (x[row, split[node]] > cut[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Boost complete trees on logistic loss; splits are bin edges chosen from gradient histograms."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if not len(y) or y.min() == y.max():
        mean = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), float(np.log(mean / (1 - mean))))
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(f)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, start)
    splits, cuts, leafs = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        split, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            base, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for j in range(f):
                at = (node - base) * bins + binned[:, j]
                gs = np.bincount(at, g, width * bins).reshape(width, bins).cumsum(1)
                hs = np.bincount(at, h, width * bins).reshape(width, bins).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl ** 2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt ** 2 / (ht + RIDGE)
                gain[(hl < LEAST) | (ht - hl < LEAST)] = 0
                gain[:, len(edges[j]):] = 0
                k = gain.argmax(1)
                value = gain[np.arange(width), k]
                better = value > best
                best[better] = value[better]
                split[base + np.flatnonzero(better)] = j
                cut[base + np.flatnonzero(better)] = edges[j][np.minimum(k[better], len(edges[j]) - 1)]
            node = 2 * node + 1 + (x[np.arange(n), split[node]] > cut[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + RIDGE)
        margin += leaf[at]
        splits.append(split)
        cuts.append(cut)
        leafs.append(leaf)
    return Forest(np.array(splits), np.array(cuts), np.array(leafs), start)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "quality", rows: int = SAMPLE) -> Forest:
    """Fit on the training sample's statistics (at most ``rows`` rows reach the driver)."""
    arrow_batches(spark)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch_statistics(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), lists], names=["doc_id", "label", "x"])

    texts = labelled_texts(docs, labels, column, rows)
    found = texts.mapInArrow(task, "doc_id long, label int, x array<double>").orderBy("doc_id").toPandas()
    x = np.array(found["x"].tolist(), float).reshape(-1, len(STATISTICS))
    return fit(x, found["label"].to_numpy(float))


def score(spark: SparkSession, docs: DataFrame, model: Forest, name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for every whole ``text``; no shuffle."""
    arrow_batches(spark)
    forest = spark.sparkContext.broadcast(model)
    names, at, new = docs.columns, docs.columns.index("text"), fresh(docs, name)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = forest.value.score(batch_statistics(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64())], names=[*names, new])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(new, T.DoubleType())]))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    name = fresh(docs, "score")
    scored = score(spark, docs, train(spark, docs, labels), name)
    return scored.where(F.col(name) >= threshold).drop(name)
