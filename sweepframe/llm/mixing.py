"""Mixing sources to target weights by balanced sampling (the cube method).

Each source has a target number of words; a document is repeated
``floor(target / source size)`` times for certain, and once more with the
fractional part as its inclusion probability.  The cube method rounds those
probabilities to 0 or 1 while keeping each source's word total and document
total where they are: three undecided documents at a time move along the
null space of the two balancing equations until one of them is decided.

A source is cut into blocks of about ``BLOCK`` documents by a hash of the
id (and a number, for repeated rows), so one that holds any share of the rows is balanced by many tasks.  A
block leaves at most two undecided documents and sets some of every size
aside (``CHANGE``); those of all blocks form the next round, until a source
fits one block.  There the last two are landed on the choice whose word total is
closest, and what is still missing or over is made up by turning over the
largest documents that fit, as with small change.

Defined results: null text has size 0; the null source is a source of its
own and comes last; a source without words has target 0 and takes nothing;
repeated rows are units of their own; no rows give no rows.  The choice is a
function of (id, size, text, source) and ``seed`` alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sweepframe.llm.common import SPACE, blank, fresh, hot_join, maybe_broadcast, numbered, written

#: Documents per block of a flight.
BLOCK = 4096
#: Places, in a block sorted from its largest document, of those that stay undecided for the last round.
CHANGE = (1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 3 / 4, 7 / 8, 0.999)
#: A source's target is at most this many times its size.
MAX_REPEAT = 3
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)


def size_of(text: str | Column) -> Column:
    return F.regexp_count(blank(text), F.lit(SPACE.replace("[", "[^", 1) + "+")).cast("long")


def source_targets(sources: DataFrame) -> DataFrame:
    """``source_size`` per ``source`` -> also ``target``: shares of the total by weight,
    at most ``MAX_REPEAT`` times the source, the excess reshared by weight.

    Sources in ascending order of cap over weight: the first one whose share of
    what the capped ones leave is within its cap ends the capping.  The window
    runs over one row per source.
    """
    n = len(WEIGHTS)
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    in_order = W.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("i", F.row_number().over(in_order) - 1)
    ranked = ranked.withColumn("w", F.element_at(weights, (F.pmod("i", F.lit(n)) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * MAX_REPEAT)
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), "i")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    x = ranked.select("*", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                      .alias("rest"), F.sum("w").over(onward).alias("w_rest"), F.row_number().over(by_ratio).alias("k"))
    x = x.withColumn("first_free", F.min(F.when(F.col("rest") * F.col("w") <= F.col("cap") * F.col("w_rest"),
                                                F.struct("k", "rest", "w_rest"))).over(whole))
    free = F.col("first_free.rest").cast("double") * F.col("w") / F.col("first_free.w_rest")
    target = F.when(F.col("k") < F.col("first_free.k"), F.col("cap").cast("double")).otherwise(free)
    return x.select(*sources.columns, target.alias("target"))


def flight(pi: np.ndarray, size: np.ndarray, draw: np.random.Generator, land: bool) -> np.ndarray:
    """Cube-method flight over units in the given order, balancing their number and their sizes.

    Returns the probabilities, all 0 or 1 but for at most two of them and those
    at ``CHANGE``; ``land`` decides all, for the smallest change of the word total.
    """
    p, s = pi.tolist(), size.tolist()
    live: list[int] = []
    uniform = iter(draw.random(4 * len(p) + 8).tolist())
    aside = set() if land else {int(len(p) * x) for x in CHANGE}
    todo = iter([k for k in range(len(p)) if k not in aside])
    eps = 1e-9
    while True:
        while len(live) < 3 and (k := next(todo, None)) is not None:
            if p[k] <= eps or p[k] >= 1 - eps:
                p[k] = float(round(p[k]))
            else:
                live.append(k)
        if len(live) == 3:
            a, b, c = live
            u = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
            if not (u[0] or u[1] or u[2]):
                u = (1, -1, 0)
        elif len(live) == 2 and s[live[0]] == s[live[1]]:
            u = (1, -1)
        else:
            break
        up = min((1 - p[k]) / d if d > 0 else p[k] / -d for k, d in zip(live, u) if d)
        down = min(p[k] / d if d > 0 else (1 - p[k]) / -d for k, d in zip(live, u) if d)
        step = up if next(uniform) * (up + down) < down else -down
        for k, d in zip(live, u):
            p[k] += step * d
            if p[k] <= eps or p[k] >= 1 - eps:
                p[k] = float(round(p[k]))
        live = [k for k in live if 0 < p[k] < 1]
    if land and live:
        want = sum(p[k] * s[k] for k in live)
        n = sum(p[k] for k in live)
        ways = [[m >> j & 1 for j in range(len(live))] for m in range(1 << len(live))]
        best = min(ways, key=lambda w: (abs(sum(x * s[k] for x, k in zip(w, live)) - want), abs(sum(w) - n), w))
        for x, k in zip(best, live):
            p[k] = float(x)
    if land:
        over = sum(x * v for x, v in zip(p, s)) - float(np.dot(pi, size))
        for k, v in enumerate(s):
            if 0 < v <= abs(over) and (p[k] == 1.0) == (over > 0):
                over -= v if over > 0 else -v
                p[k] = 1.0 - p[k]
        fits = [(abs(abs(over) - v), k) for k, v in enumerate(s) if (p[k] == 1.0) == (over > 0)]
        if fits and min(fits)[0] < abs(over):
            p[min(fits)[1]] = 1.0 - p[min(fits)[1]]
    return np.array(p)


def _balance(units: DataFrame, seed: int, level: int) -> DataFrame:
    """One round of flights over ``units (rid, key, n_left, u, size, pi)`` in blocks."""

    def fly(block: pd.DataFrame) -> pd.DataFrame:
        # The largest first: what is left to land are the smallest.
        block = block.sort_values(["size", "u", "rid"], ascending=[False, True, True], ignore_index=True)
        name = f"{seed}/{level}/{block['key'].iat[0]}/{block['block'].iat[0]}"
        draw = np.random.default_rng(zlib.crc32(name.encode("utf-8", "surrogatepass")))
        land = bool(block["blocks"].iat[0] == 1)
        block["pi"] = flight(block["pi"].to_numpy(), block["size"].to_numpy(), draw, land)
        return block[["rid", "key", "u", "size", "pi"]]

    blocks = F.ceil(F.col("n_left") / BLOCK)
    cut = units.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("u", F.lit(level)), "blocks"))
    return cut.groupBy("key", "block").applyInPandas(fly, "rid long, key string, u long, size long, pi double")


def _apart(spark: SparkSession, staged: DataFrame) -> DataFrame:
    """``staged`` with a ``u`` of their own for rows that repeat one, so that blocks can part them.

    Such rows are numbered, about ``BLOCK`` of them at a time, and the number is
    mixed into ``u``.  They are alike, so it does not matter which gets which.
    """
    rows = staged.withColumn("alike", F.xxhash64("key", "u"))
    again = written(spark, rows.groupBy("alike").agg(F.count(F.lit(1)).alias("n_alike")).where("n_alike > 1"), "mix_again")
    if not again.limit(1).count():
        return staged
    rows = hot_join(rows, again, "alike", "n_alike", staged.count(), "left")
    rows = written(spark, rows.withColumn("deal", F.pmod(F.xxhash64("rid"), F.ceil(F.col("n_alike") / BLOCK))), "mix_alike")
    repeated = rows.where("n_alike IS NOT NULL")
    before = W.partitionBy("alike").orderBy("deal").rowsBetween(W.unboundedPreceding, -1)
    dealt = repeated.groupBy("alike", "deal").agg(F.count(F.lit(1)).alias("n_dealt"))
    dealt = dealt.select("alike", "deal", F.coalesce(F.sum("n_dealt").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(W.partitionBy("alike", "deal").orderBy("rid")) - 1
    repeated = repeated.withColumn("number", within).join(dealt, ["alike", "deal"])
    number = F.col("first") + F.col("number")
    repeated = repeated.withColumn("u", F.when(number == 0, F.col("u")).otherwise(F.xxhash64("u", number)))
    return written(spark, rows.where("n_alike IS NULL").select(*staged.columns)
                   .unionByName(repeated.select(*staged.columns)), "mix_apart")


def decide(spark: SparkSession, staged: DataFrame, seed: int = 0) -> DataFrame:
    """``staged (rid, doc_id, key, source, size, u)`` -> per row ``rid, doc_id, size, source_size, target, times``."""
    staged = _apart(spark, staged)
    sources = written(spark, staged.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"),
                                                       F.count(F.lit(1)).alias("n_source")), "mix_sources")
    sources = written(spark, source_targets(sources).drop("source"), "mix_targets")
    total = staged.count()
    rows = hot_join(staged.drop("source"), sources, "key", "n_source", total)
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(MAX_REPEAT)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    rows = rows.withColumn("ratio", ratio)
    rows = written(spark, rows.select("rid", "doc_id", "key", "u", "size", "source_size", "target", "n_source",
                                      F.floor("ratio").alias("base"), (F.col("ratio") - F.floor("ratio")).alias("pi")), "mix_rows")
    left = rows.where("pi > 0").select("rid", "key", "u", "size", "pi", F.col("n_source").alias("n_left"))
    level, decided = 0, None
    while True:
        flown = written(spark, _balance(left, seed, level), "mix_flight")
        part = flown.where("pi IN (0.0, 1.0)").select("rid", "pi")
        decided = part if decided is None else decided.unionByName(part)
        open_units = flown.where("pi > 0 AND pi < 1")
        counts = open_units.groupBy("key").agg(F.count(F.lit(1)).alias("n_left"))
        n = open_units.count()
        if not n:
            break
        left = hot_join(open_units, counts, "key", "n_left", n)
        level += 1
    extra = decided.where("pi = 1.0").select("rid", F.lit(1).cast("long").alias("extra"))
    return (rows.join(extra, "rid", "left")
            .select("rid", "doc_id", "size", "source_size", "target",
                    (F.col("base") + F.coalesce("extra", F.lit(0))).cast("long").alias("times")))


def _units(docs: DataFrame, rid: Column) -> DataFrame:
    """Balancing units; rows without an id are spread by their row number."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(rid.alias("rid"), doc_id.alias("doc_id"),
                       F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))).alias("key"),
                       F.col("source"), size_of("text").alias("size"),
                       F.xxhash64(doc_id, F.col("text"), F.when(doc_id.isNull(), rid)).alias("u"))


def mix_report(spark: SparkSession, docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` (words the mix takes)."""
    staged = written(spark, _units(docs, F.monotonically_increasing_id()), "mix_staged")
    out = decide(spark, staged, seed)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mix(spark: SparkSession, docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mixed documents with all their columns, each repeated as often as the mix takes it."""
    full, rid = numbered(spark, docs, "mix_full")
    times = fresh(full, "times")
    staged = written(spark, _units(full, F.col(rid)), "mix_staged")
    made = written(spark, decide(spark, staged, seed).where("times > 0").select("rid", F.col("times").cast("int").alias(times)),
                   "mix_made")
    made = maybe_broadcast(made, made.count())
    out = full.join(made, full[rid] == made["rid"])
    out = out.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return out.select(*[full[f"`{c}`"] for c in docs.columns])
