"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its link components.

Every document is a set of n-word shingles, held as 64-bit hashes.  Shingles
are ordered: first those not known to be frequent, by hash, then the
frequent ones by count (kept in ``COUNTERS`` counters over all documents,
which shingles share; results do not depend on the order).  If two sets are similar enough, their prefixes of
length ``size - least overlap + m`` share at least ``m`` shingles.  Each
document picks its own ``m`` (1 to ``MAX_MATCHES``): the prefix grows by one
shingle with each step, and the number of candidates, at most the sum of
the prefix's counts over ``m``, falls.  A pair is verified only if it shares
``min(m, m')`` shingles within both prefixes of that level.

Groups of copies are never expanded into all pairs.  Documents with equal
sets become one node.  In each list of nodes that share a prefix shingle,
every node is first verified against one pivot, the node that has it earliest
(fewest shingles of its own before it); that joins the bulk of a group.  Only nodes that are still in different
components are then paired, under the size and position bounds of the
sets.  A list of two nodes is settled by its pivot.  Before any set is moved, parity bitmaps bound a pair from above: each
shingle flips one of ``BITS`` bits, so two sets differ in at least as many
shingles as their bitmaps in bits.  Components are the same as those of all pairs, since a pair inside a
component adds nothing to it.

Defined results: a document with fewer words than a shingle has its whole
sequence as one shingle; without words, or null, its set is empty and links
with nothing; rows that share an id count as versions of one document; a row
whose id is null is linked with its exact copies only (without an id among
them its component is null, and ``deduplicate`` keeps it);
other columns pass through ``deduplicate``; no rows give no rows.

What is broadcast: the weights of the counters (``COUNTERS`` numbers), and id
lists within ``BROADCAST_ROWS`` (else a shuffle join).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sweepframe.llm import textcore as tc
from sweepframe.llm.common import arrow_batches, hot_join, maybe_broadcast, numbered, written
from sweepframe.llm.components import components

MAX_MATCHES = 4
#: Cost of verifying a candidate, in postings scanned.
VERIFY_COST = 16
#: Counters over all shingles, by the upper bits of their hashes (a power of two; 4 bytes each in a task).
COUNTERS = 1 << 20
#: Shingles added to the counters at a time.
COUNTED = 1 << 18
#: Least bits of a set's parity bitmap (a power of two, at least half the set's size),
#: and bits of the folded one that list rows carry.
BITS, FOLDED = 512, 256


def parity(tokens: np.ndarray, off: np.ndarray) -> pa.Array:
    """The parity bitmap of each set, as 64-bit integers."""
    size = np.diff(off)
    bits = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(size, 2) / 2)).astype(np.int64))
    base = np.r_[0, np.cumsum(bits)]
    at = np.repeat(base[:-1], size) + (tokens >> np.uint64(7)).astype(np.int64) % np.repeat(bits, size)
    odd = (np.bincount(at, minlength=int(base[-1])) & 1).astype(np.uint8)
    words = np.packbits(odd).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(base // 64, pa.int32()), pa.array(words))


def counter_of(tokens: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return (tokens >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)


def _profiles(docs: DataFrame, n: int) -> DataFrame:
    """One pass: a row per document with its set's size and digest, and a task's counters that are not 0."""
    schema = "rid long, doc_id long, n_shingles long, digest binary, bits array<long>, counter int, times long"
    names = ["rid", "doc_id", "n_shingles", "digest", "bits", "counter", "times"]

    def add(counters: np.ndarray, held: list[np.ndarray]) -> None:
        every = np.concatenate([counter_of(t) for t in held])
        every.sort()
        edge = np.flatnonzero(np.r_[True, every[1:] != every[:-1], True])
        counters[every[edge[:-1]]] += np.diff(edge).astype(np.uint32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint32)
        held, n_held = [], 0
        for batch in batches:
            for lo, hi in tc.chunks(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                tokens, off = tc.shingles(tc.words(part.column(2), tc.SPACED), n)
                digest = [hashlib.blake2b(tokens[a:b].tobytes(), digest_size=16).digest() for a, b in zip(off[:-1], off[1:])]
                k = len(digest)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(off), pa.int64()), pa.array(digest, pa.binary()),
                     parity(tokens, off), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())], names=names)
                held.append(tokens)
                n_held += len(tokens)
                if n_held >= COUNTED:
                    add(counters, held)
                    held, n_held = [], 0
        if n_held:
            add(counters, held)
        used = np.flatnonzero(counters).astype(np.int32)
        for at in range(0, len(used), COUNTED):
            some = used[at:at + COUNTED]
            none = [pa.nulls(len(some), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array(some), pa.array(counters[some].astype(np.int64))], names=names)

    return docs.select("rid", "doc_id", "text").mapInArrow(task, schema)


def _frequent(profiles: DataFrame) -> np.ndarray:
    """The weight of each counter: its count over all documents where that stands out, else 0.

    A counter stands out by six standard deviations of an even spread, so
    what is told apart is a share of the shingles that falls as they grow.
    Those that do reach the driver: fewer than ``COUNTERS``, however many documents there are.
    """
    counted = profiles.where("counter IS NOT NULL")
    mean = (counted.agg(F.sum("times")).first()[0] or 0) / COUNTERS
    rows = (counted.groupBy("counter").agg(F.sum("times").alias("times"))
            .where(F.col("times") > mean + 6 * mean ** 0.5 + 2).toPandas())
    weight = np.zeros(COUNTERS, np.int64)
    weight[rows["counter"].to_numpy(np.int64)] = rows["times"].to_numpy(np.int64)
    return weight


def least_overlap(size, percent: int):
    """Fewest shingles that a set must share with any set similar to it."""
    return -(-percent * size // 100)


def prefix(tokens: np.ndarray, times: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """A document's prefix in the global order and its number of matches ``m``.

    ``tokens`` ascend; ``times`` is 0 for shingles that are not frequent.
    """
    size = len(tokens)
    alpha = least_overlap(size, percent)
    if times.any():
        order = np.argsort(times, kind="stable")
        tokens, times = tokens[order], times[order]
    most = min(MAX_MATCHES, alpha)
    base = size - alpha
    scanned = np.cumsum(times[:base + most])[base:].astype(float)
    m = np.arange(1, most + 1)
    matches = int(np.argmin(scanned * (1 + VERIFY_COST / m))) + 1
    return tokens[:base + matches], matches


def _prefixes(docs: DataFrame, n: int, percent: int, frequent) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = frequent.value
        for batch in batches:
            for lo, hi in tc.chunks(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                tokens, off = tc.shingles(tc.words(part.column(1), tc.SPACED), n)
                weight = times[counter_of(tokens)]
                made = [prefix(tokens[a:b], weight[a:b], percent) if b > a else (tokens[:0], 0)
                        for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                ends = np.r_[0, np.cumsum([len(p) for p, _ in made])]
                values = np.concatenate([p for p, _ in made]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(off), pa.int32()), pa.array([m for _, m in made], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                    names=["node", "size", "m", "tokens"])

    return (docs.select(F.col("doc_id").alias("node"), "text")
            .mapInArrow(task, "node long, size int, m int, tokens array<long>"))


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in tc.chunks(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                tokens, off = tc.shingles(tc.words(part.column(1), tc.SPACED), n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(tokens.view(np.int64)))],
                    names=["node", "tokens"])

    return docs.select(F.col("doc_id").alias("node"), "text").mapInArrow(task, "node long, tokens array<long>")


def _verify(spark: SparkSession, docs: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets are similar enough, by the exact intersection."""
    pairs = written(spark, pairs, "join_pairs")
    nodes = written(spark, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "join_nodes")
    few = maybe_broadcast(nodes.withColumnRenamed("node", "doc_id"), nodes.count())
    sets = written(spark, _sets(docs.join(few, "doc_id", "left_semi"), n), "join_sets")
    a, b = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b").distinct()


def _overlap(x, y, percent: int):
    """Fewest shingles that similar sets of these sizes share."""
    return -F.floor(-(percent * (x + y)) / (100 + percent))


def _halved(bits):
    """A bitmap folded to half its length: parities add up."""
    half = (F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda p, q: p.bitwiseXOR(q))


def _near(x, y, size_x, size_y, percent: int):
    """The bitmaps (of equal length) allow the sets to be similar."""
    flipped = F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    return flipped <= size_x + size_y - 2 * _overlap(size_x, size_y, percent)


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps allow them to be similar."""
    a, b = (nodes.select(F.col("node").alias(k), F.col("size").alias(f"size_{k}"), F.col("bits").alias(f"bits_{k}")) for k in "ab")
    both = pairs.join(a, "a").join(b, "b")
    # sizes of similar sets are close, so lengths differ by one doubling at most; others are left to the sets
    n_a, n_b = F.size("bits_a"), F.size("bits_b")
    both = both.withColumns({"bits_a": F.when(n_a == 2 * n_b, _halved(F.col("bits_a"))).otherwise(F.col("bits_a")),
                             "bits_b": F.when(n_b == 2 * n_a, _halved(F.col("bits_b"))).otherwise(F.col("bits_b"))})
    near = _near(F.col("bits_a"), F.col("bits_b"), F.col("size_a"), F.col("size_b"), percent)
    return both.where((F.size("bits_a") != F.size("bits_b")) | near).select("a", "b").distinct()


def _bounds(x: str, y: str, percent: int):
    """What a pair's row in a shingle's list must meet: sizes, positions and levels."""
    def c(side, name):
        return F.col(f"{side}.{name}").cast("long")

    m = F.least(c(x, "m"), c(y, "m"))
    overlap = _overlap(c(x, "size"), c(y, "size"), percent)
    rest = F.least(c(x, "size") - c(x, "pos"), c(y, "size") - c(y, "pos"))
    return ((100 * F.least(c(x, "size"), c(y, "size")) >= percent * F.greatest(c(x, "size"), c(y, "size")))
            & (c(x, "level") <= m) & (c(y, "level") <= m) & (rest >= overlap - m + 1)), m


def link_components(spark: SparkSession, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``docs (rid, doc_id, text)`` -> ``rid, doc_id, n_shingles, component_id``.

    ``docs`` is read several times, so it should come from files.
    """
    arrow_batches(spark)
    profiles = written(spark, _profiles(docs, n), "join_profiles")
    rows = profiles.where("counter IS NULL").select("rid", "doc_id", "n_shingles", "digest", "bits")
    frequent = spark.sparkContext.broadcast(_frequent(profiles))
    groups = written(spark, rows.where("n_shingles > 0").groupBy("digest")
                     .agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"),
                          F.first("n_shingles").alias("size"), F.first("bits").alias("bits")), "join_groups")
    nodes = groups.select("node", "size", "bits")
    reps = groups.select(F.col("node").alias("node"))
    copies = written(spark, rows.select(F.col("doc_id").alias("node")).join(reps, "node", "left_anti").distinct(), "join_copies")

    lists = _prefixes(docs, n, percent, frequent).where("m > 0")
    lists = lists.join(maybe_broadcast(copies, copies.count()), "node", "left_anti")
    if rows.count() != rows.select("doc_id").distinct().count():  # versions: their lists are alike or add candidates
        lists = lists.distinct()
    posts = lists.select("node", "size", "m", F.posexplode("tokens").alias("pos", "token"))
    alpha = -F.floor(-(F.col("size") * percent) / 100)
    posts = posts.withColumn("level", F.greatest(F.lit(1), F.col("pos") - F.col("size") + alpha + 1).cast("int"))
    # One shuffle by shingle: the list's length, and its pivot with what the bounds need of it.
    in_list = W.partitionBy("token")
    pivot = F.min(F.struct("pos", "node", "size", "m", "level")).over(in_list)
    shared = (posts.select("*", F.count(F.lit(1)).over(in_list).alias("listed"), pivot.alias("y"),
                           F.min("m").over(in_list).alias("least"))
              .where("listed > 1"))
    # a list of two, of which one asks for one match only, is settled by its pivot
    shared = shared.withColumn("settled", (F.col("listed") == 2) & (F.col("least") == 1)).drop("listed", "least")
    shared = written(spark, shared, "join_posts")

    # Round one: each node with the pivot of each of its lists.
    met = shared.select(F.struct("node", "size", "m", "pos", "level").alias("x"), "y")
    fits, _ = _bounds("x", "y", percent)
    first = met.where((F.col("x.node") != F.col("y.node")) & fits).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    first = written(spark, first, "join_first")
    links = written(spark, _verify(spark, docs, _plausible(first, nodes, percent), n, percent), "join_links")
    grouped = written(spark, components(spark, links), "join_grouped")

    # Round two: nodes of one list that are in different components.
    left = shared.where("NOT settled").drop("y", "settled")
    labelled = (left.join(maybe_broadcast(grouped, grouped.count()), "node", "left")
                .withColumn("comp", F.coalesce("comp", "node")))
    labelled = written(spark, labelled, "join_labelled")
    open_lists = labelled.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    words = F.array(*[F.lit(i) for i in range(FOLDED // 64)])
    folded = F.transform(words, lambda i: F.aggregate(F.filter("bits", lambda _, j: j % (FOLDED // 64) == i),
                                                      F.lit(0).cast("long"), lambda p, q: p.bitwiseXOR(q)))
    maps = nodes.select("node", folded.alias("bits"))
    open_posts = (labelled.join(open_lists, "token", "left_semi").join(maybe_broadcast(maps, maps.count()), "node"))
    open_posts = written(spark, open_posts, "join_open")
    x, y = open_posts.alias("x"), open_posts.alias("y")
    fits, m = _bounds("x", "y", percent)
    pairs = x.join(y.hint("merge"), (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
                   & (F.col("x.comp") != F.col("y.comp")) & fits
                   & _near(F.col("x.bits"), F.col("y.bits"), F.col("x.size"), F.col("y.size"), percent))
    pairs = (pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
             .agg(F.count(F.lit(1)).alias("matches"), F.min(m).alias("least"))
             .where("matches >= least").select("a", "b").join(first, ["a", "b"], "left_anti"))
    more = written(spark, _verify(spark, docs, _plausible(pairs, nodes, percent), n, percent), "join_more")
    grouped = components(spark, links.union(more))

    named = groups.drop("bits").join(grouped, "node", "left").select("digest", F.coalesce("comp", "node").alias("component_id"), "copies")
    some = rows.where("n_shingles > 0").drop("bits")
    linked = hot_join(some, written(spark, named, "join_named"), "digest", "copies", max(1, some.count()))
    cols = ["rid", "doc_id", "n_shingles", "component_id"]
    return linked.select(cols).union(rows.where("n_shingles = 0").drop("bits").withColumn("component_id", F.col("doc_id")).select(cols))


def report(spark: SparkSession, docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id`` (the smallest id reachable by links)."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return link_components(spark, rows, n, percent).drop("rid")


def deduplicate(spark: SparkSession, docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id, with all its columns."""
    full, rid = numbered(spark, docs, "join_full")
    rows = full.select(F.col(rid).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    found = written(spark, link_components(spark, rows, n, percent), "join_found")
    linked = found.where("n_shingles > 0 AND component_id IS NOT NULL")
    keep = linked.groupBy("component_id").agg(F.min(F.struct("doc_id", "rid")).alias("k")).select(F.col("k.rid").alias("rid"))
    drop = written(spark, linked.select("rid").join(keep, "rid", "left_anti"), "join_drop")
    drop = maybe_broadcast(drop, drop.count())
    return full.join(drop, full[rid] == drop["rid"], "left_anti").select(*[full[f"`{c}`"] for c in docs.columns])
