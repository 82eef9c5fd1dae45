"""Hard negatives by exact integer scores from a residue-number-system product.

Vectors become integers, ``floor(SCALE * x)``.  Candidates are packed into
blocks where they lie and anchors into smaller ones; every anchor block meets
every candidate block once, by an equi-join on a bucket of candidate blocks.
In a pair of blocks the component matrices are reduced modulo a few primes
and multiplied in float32, ``WIDTH`` components at a time, so that every sum
is below 2^24 and exact; Chinese remaindering (mixed radix, symmetric digits)
gives the signed scores.  As many primes are used as the blocks' norms ask
for.  Two passes run over the pairs: the first keeps each anchor's best rows
of its own label (its positives), the second, per positive, the best rows of
other labels whose score lies in the window below the positive's.  Each
block's best are merged by a rank window, whose key is one anchor's (or one
positive's) few rows per block.

Defined results: rows whose id, label or vector is null, or whose vector holds
a null or non-finite value, take no part; shorter vectors count as padded with
zeros; ties go to the smaller id; rows of the anchor's own id are neither its
positives nor its negatives; rows that repeat an id are anchors and candidates
each; an anchor without positives, or a positive without rows in its window,
gives no rows, as does an empty table.  Other columns are not read.  Scores
that could leave 64 bits fail the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sweepframe.llm.common import arrow_batches, written

SCALE = 256
#: Window of a negative's score as percent of the positive's.
LOW, HIGH = 80, 100
#: Vector components in a block of candidates or anchors, and anchors in a block, at most.
CELLS, ANCHORS = 1 << 20, 4096
#: Rows of anchors whose scores against a block are held at once.
TILE = 64
#: Pairwise prime; WIDTH products of symmetric residues stay below 2^24.
PRIMES = (1021, 1019, 1013, 1009, 997, 991, 983)
WIDTH = 64


def residues(m: np.ndarray, prime: int) -> np.ndarray:
    """``m`` modulo ``prime``, in the symmetric range, as float32."""
    r = m % prime
    return np.where(r > prime // 2, r - prime, r).astype(np.float32)


class Residues:
    """A block's component matrix modulo as many primes as were asked for."""

    def __init__(self, m: np.ndarray):
        self.m, self.parts = m, []
        self.norm = float(np.sqrt((m.astype(float) ** 2).sum(1)).max(initial=0.0))

    def modulo(self, i: int) -> np.ndarray:
        while len(self.parts) <= i:
            self.parts.append(residues(self.m, PRIMES[len(self.parts)]))
        return self.parts[i]


def primes_for(a: Residues, b: Residues) -> int:
    """Primes whose product is more than twice the largest possible score (Cauchy-Schwarz)."""
    bound, product = 2.0 * a.norm * b.norm * (1 + 1e-9) + 2, 1
    for n, p in enumerate(PRIMES):
        product *= p
        if bound < min(product, 2.0 ** 64):
            return n + 1
    raise OverflowError("scores beyond 64 bits")


def scores(a: Residues, b: Residues, rows: slice = slice(None)) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with those of ``b``, as 64-bit integers."""
    dims = min(a.m.shape[1], b.m.shape[1])
    digits: list[np.ndarray] = []
    for i in range(primes_for(a, b)):
        p = PRIMES[i]
        x, y = a.modulo(i)[rows], b.modulo(i)
        total = np.zeros((x.shape[0], y.shape[0]), np.int32)
        for lo in range(0, dims, WIDTH):
            part = x[:, lo:min(lo + WIDTH, dims)] @ y[:, lo:min(lo + WIDTH, dims)].T
            total = (total + part.astype(np.int32)) % p  # exact: below 2^24, and 0 <= total < 1021
        total %= p
        # mixed radix: subtract what the earlier digits say, divide by their primes, modulo p
        for j, d in enumerate(digits):
            total = (total - d) * pow(PRIMES[j], -1, p) % p
        digits.append(np.where(total > p // 2, total - p, total).astype(np.int32))
    out, weight = np.zeros_like(digits[0], np.int64), 1
    for p, d in zip(PRIMES, digits):
        out += d.astype(np.int64) * np.int64(weight)  # may wrap on the way; the sum does not
        weight *= p
    return out


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same values in the smallest signed type that holds them."""
    lo, hi = int(m.min(initial=0)), int(m.max(initial=0))
    for t in ("<i2", "<i4"):
        if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max:
            return m.astype(t)
    return m.astype("<i8")


_BLOCK = "n int, dims int, width int, ids binary, labels binary, rids binary, values binary, bars binary"


def _packed(rows: DataFrame) -> DataFrame:
    """Rows ``id, label, rid, v[, bars]`` packed within their partitions into blocks of about ``CELLS`` components,
    numbered ``b``."""
    barred = "bars" in rows.columns

    def out(held: list[tuple], vs: list[np.ndarray]) -> pa.RecordBatch:
        dims = max(map(len, vs))
        m = np.zeros((len(vs), dims), "<i8")
        for row, v in zip(m, vs):
            row[:len(v)] = v
        m = _narrow(m)
        bars = np.concatenate([np.array(h[3], "<i8") for h in held]) if barred else np.zeros(0, "<i8")
        longs = [np.array([h[i] for h in held], "<i8").tobytes() for i in range(3)]
        return pa.RecordBatch.from_pydict({
            "n": pa.array([len(vs)], pa.int32()), "dims": pa.array([dims], pa.int32()),
            "width": pa.array([m.itemsize], pa.int32()), "ids": [longs[0]], "labels": [longs[1]], "rids": [longs[2]],
            "values": [m.tobytes()], "bars": [bars.tobytes()]})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vs, used = [], [], 0
        for batch in batches:
            v = batch.column(3)
            off, flat = v.offsets.to_numpy(), v.values.to_numpy()
            bars = batch.column(4).to_pylist() if barred else [None] * len(batch)
            for i, label, rid, bar, a, b in zip(*[batch.column(c).to_pylist() for c in range(3)], bars, off[:-1], off[1:]):
                if vs and used + b - a > CELLS:
                    yield out(held, vs)
                    held, vs, used = [], [], 0
                held.append((i, label, rid, bar))
                vs.append(flat[a:b].copy())
                used += max(1, int(b - a))
        if vs:
            yield out(held, vs)

    wanted = ["id", "label", "rid", "v"] + (["bars"] if barred else [])
    return rows.select(*wanted).mapInArrow(task, _BLOCK).withColumn("b", F.monotonically_increasing_id())


def _unpacked(r: dict, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Residues]:
    m = np.frombuffer(r[prefix + "values"], f"<i{r[prefix + 'width']}").reshape(r[prefix + "n"], r[prefix + "dims"])
    ids, labels, rids = (np.frombuffer(r[prefix + c], "<i8") for c in ("ids", "labels", "rids"))
    return ids, labels, rids, Residues(m.astype(np.int64))


def first_of(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """The k rows of highest score, ties to the smaller id."""
    if len(rows) > 4 * k:  # all that tie with the k-th stay in
        rows = rows[score[rows] >= np.partition(score[rows], -k)[-k]]
    return rows[np.lexsort((ids[rows], -score[rows]))[:k]]


def _met(cand: DataFrame, anchors: DataFrame, blocks: int, cores: int) -> DataFrame:
    """Every anchor block beside every candidate block, once.

    Candidate blocks go to ``blocks`` buckets and anchor blocks to all of
    them, so each key holds a few candidate blocks; while there are fewer
    buckets than ``cores`` use, anchor blocks are dealt over copies of them.
    """
    copies = max(1, -(-2 * cores // max(1, blocks)))
    names = ("n", "dims", "width", "ids", "labels", "rids", "values", "bars")
    left = (cand.withColumn("bucket", F.pmod(F.xxhash64("b"), F.lit(blocks)))
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))
    right = (anchors.select(F.pmod(F.xxhash64("b"), F.lit(copies)).cast("int").alias("copy"), *[F.col(c).alias("a_" + c) for c in names])
             .withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    # anchors stream past a key's few candidate blocks
    return right.join(left.hint("merge"), ["bucket", "copy"]).select(*names[:-1], *["a_" + c for c in names])


def _search(pairs: DataFrame, k: int, pick: Callable, schema: str) -> DataFrame:
    """``pick(score, ids, other, at, bars)`` yields ``(slot, rows)`` for each anchor of a pair of blocks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):  # one pair at a time: blocks take megabytes
                r = {c: batch.column(j)[n].as_py() for j, c in enumerate(batch.schema.names)}
                ids, labels, rids, cand = _unpacked(r, "")
                a_ids, a_labels, a_rids, anch = _unpacked(r, "a_")
                bars = np.frombuffer(r["a_bars"], "<i8").reshape(len(a_ids), -1) if len(r["a_bars"]) else None
                rid, slot, who, got = [], [], [], []
                for lo in range(0, len(a_ids), TILE):
                    tile = scores(anch, cand, slice(lo, lo + TILE))
                    for i, s in enumerate(tile, lo):
                        free = ids != a_ids[i]
                        for at, rows in pick(s, ids, labels == a_labels[i], free, None if bars is None else bars[i]):
                            rid.append(np.full(len(rows), a_rids[i]))
                            slot.append(np.full(len(rows), at, np.int32))
                            who.append(ids[rows])
                            got.append(s[rows])
                if rid:
                    yield pa.RecordBatch.from_pydict({"rid": np.concatenate(rid), "slot": np.concatenate(slot),
                                                      "vec_id": np.concatenate(who), "score": np.concatenate(got)})

    found = pairs.mapInArrow(task, schema)
    order = W.partitionBy("rid", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


_FOUND = "rid long, slot int, vec_id long, score long"


def mine(spark: SparkSession, vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, key: str = "vec_id",
         vector: str = "embedding", label: Column | str = "label", scale: int = SCALE, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is the condition on ``vectors`` that makes a row an anchor,
    ``label`` the column (or expression over ``vectors``) of labels.  A
    negative's score s fulfils ``low * p <= 100 * s <= high * p`` for the
    positive's score p.  The work is anchors times rows.
    """
    arrow_batches(spark)  # a row of the pairs takes megabytes
    x = F.col(vector)
    label = F.col(label) if isinstance(label, str) else label
    fine = F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))), F.lit(False))
    rows = vectors.where(F.col(key).isNotNull() & label.isNotNull() & fine).select(
        F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.transform(x, lambda e: F.floor(scale * e.cast("double"))).alias("v"), F.monotonically_increasing_id().alias("rid"))
    rows = written(spark, rows, "negatives_rows")
    cand = written(spark, _packed(rows), "negatives_blocks")
    blocks, cores = max(1, cand.count()), spark.sparkContext.defaultParallelism
    asked = rows.where("anchor")
    parts = max(1, -(-asked.count() // ANCHORS))

    def met(a: DataFrame) -> DataFrame:
        return _met(cand, written(spark, _packed(a.repartition(parts, "rid")), "negatives_anchors"), blocks, cores)

    def own_label(s, ids, same, free, bars):
        yield 0, first_of(s, ids, np.flatnonzero(same & free), positives)

    near = written(spark, _search(met(asked), positives, own_label, _FOUND), "negatives_positives")
    near = near.select("rid", (F.col("rank") - 1).cast("int").alias("slot"), F.col("vec_id").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    none = -(1 << 62)  # bar of a slot without positive: its window is empty
    bars = near.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("slot", "positive_score"))).alias("m"))  # a few an anchor
    bars = bars.select("rid", F.array(*[F.coalesce(F.try_element_at("m", F.lit(i)), F.lit(none)) for i in range(positives)]).alias("bars"))

    def below(s, ids, same, free, bars):
        other = np.flatnonzero(~same & free)
        t = s[other]
        for at, p in enumerate(bars.tolist()):
            if p != none:
                inside = other[(t >= -(-low * p // 100)) & (t <= high * p // 100)]
                if len(inside):
                    yield at, first_of(s, ids, inside, negatives)

    hard = _search(met(asked.join(bars, "rid")), negatives, below, _FOUND)
    named = near.join(asked.select("rid", F.col("id").alias("anchor_id")), "rid")
    return hard.join(named, ["rid", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
