"""Prefix trie of conversations: padded matrices of turn ids, sorted and reduced column by column.

A turn's id is a 128-bit hash (two 64-bit columns) of its position, role and
text, so a node (the first d turns of its members) is named by d and the
exclusive-or of its turns' ids.  Conversations are cut into chunks of
``WIDTH`` turns, each knowing the name of the node it starts from, so one of
any length is many bounded rows.  Chunk rows are range-sharded by starting
node, first turns and conversation; a group of copies is split by the last.
Each task pads its shard to a matrix, sorts it with ``lexsort``, accumulates
"a column differs from the row above" with OR along the rows, whose marks are
where nodes start, and aggregates every depth with ``reduceat``.  A node
whose first turns equal those of the shard's first or last row may go on in
another shard: only such boundary nodes are grouped again, their children
counted and their sums passed to their ancestors inside the chunk.  Sums over
what follows a chunk reach its nodes by way of each node's smallest member,
since a node below u has its smallest member among u's.

Turns are numbered by a range sort and offsets per partition, so no task sees
a whole conversation.  The hash of a node's ids is sequential by definition:
boundary nodes' ids come as text, a piece per shard, and stream in order.

Defined results: rows without conversation id take no part; turns that share
a number are ordered by the hash of role and text, and equal ones are turns
each; null roles and texts read as empty; no rows give no nodes; other columns
are not read.  Turns are told apart by the 128-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sweepframe.llm.common import arrow_batches, blank, hot_join, written

#: Turns of a chunk; a chunk row also holds the turn after them, to count children.
WIDTH = 32
#: Chunk rows of a shard, about.
SHARD = 50_000
#: Turns that the shards' order looks at, 32 bits of each.
PATH = 8
#: Chunks whose running totals one window makes.
SPAN = 1024

_KEY = ["k", "depth", "n1", "n2"]


# -- rebuilt conversations ---------------------------------------------------

def _numbered(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``part, conv_id, gid, h1, h2, chars`` and their runs ``part, conv_id, lo, before, total``.

    A turn's position in its conversation is ``gid - lo + before``.
    """
    role, text = blank(F.col("role").cast("string")), blank(F.col("text").cast("string"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), role, text).alias("h2"), F.char_length(text).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("tie"))  # equal turns, too, are dealt over partitions
    order = ["conv_id", F.asc_nulls_first("turn"), "h1", "h2", "tie"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("gid", F.monotonically_increasing_id())
    turns = written(spark, turns.select("conv_id", "gid", "h1", "h2", "chars"), "trie_turns")
    turns = turns.withColumn("part", F.shiftright("gid", 33))
    runs = turns.groupBy("part", "conv_id").agg(F.min("gid").alias("lo"), F.count(F.lit(1)).alias("n"))
    one = W.partitionBy("conv_id")
    earlier = one.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("part", "conv_id", "lo", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(one).alias("total"))
    return turns, written(spark, runs, "trie_runs")


def _rebuilt(spark: SparkSession, conversations: DataFrame, base: Column | None, head: Column | None) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, len, pos, h1, h2, chars`` of the rebuilt conversations, and ``conv_id, len`` of all of them.

    A conversation takes the first ``head`` turns of conversation ``base``
    and its own turns after its first ``head``.  A base lends to a bounded
    number of conversations.
    """
    turns, runs = _numbered(spark, conversations)
    convs = runs.where("before = 0").select("conv_id", "total")
    if base is None:
        convs = convs.select("conv_id", F.col("total").alias("len"), F.lit(0).alias("head"), F.lit(0).alias("lent"), F.col("conv_id").alias("base"))
    else:
        convs = convs.withColumn("base", base).withColumn("head", F.when(F.col("base") == F.col("conv_id"), 0).otherwise(head.cast("int")))
        lender = convs.select(F.col("conv_id").alias("base"), F.col("total").alias("lends"))
        convs = convs.join(lender, "base", "left").withColumn("lent", F.least("head", F.coalesce("lends", F.lit(0))).cast("int"))
        convs = convs.withColumn("len", F.col("lent") + F.greatest(F.col("total") - F.col("head"), F.lit(0)))
        convs = written(spark, convs.select("conv_id", "len", "head", "lent", "base"), "trie_conversations")
    # a long conversation has many runs, each of them in one partition
    own = turns.join(runs.join(convs, "conv_id"), ["part", "conv_id"])
    own = own.withColumn("at", F.col("gid") - F.col("lo") + F.col("before"))
    out = own.where(F.col("at") >= F.col("head")).select(
        "conv_id", "len", (F.col("at") - F.col("head") + F.col("lent")).alias("pos"), "h1", "h2", "chars")
    if base is not None:
        asks = convs.where("lent > 0").select("base", "conv_id", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lent") - F.lit(1).cast("long"))).alias("pos"))
        lent = own.where("conv_id = base").select("base", F.col("at").alias("pos"), "h1", "h2", "chars")
        out = out.unionByName(asks.join(lent, ["base", "pos"]).select("conv_id", "len", "pos", "h1", "h2", "chars"))
    return out, convs.select("conv_id", "len")


def _others(df: DataFrame, columns: list[str], agg: Callable, join: Callable, later: bool = False) -> DataFrame:
    """``conv_id, k`` and, per column, its total over the conversation's earlier (or later) chunks.

    Totals of ``SPAN`` chunks come first, so a window sees that many rows of a
    long conversation, or one row for each of its spans.
    """
    way = F.desc if later else F.asc
    df = df.withColumn("span", F.expr(f"k div {SPAN}"))
    spans = df.groupBy("conv_id", "span").agg(*[agg(c).alias(c) for c in columns])
    outer = W.partitionBy("conv_id").orderBy(way("span")).rowsBetween(W.unboundedPreceding, -1)
    spans = spans.select("conv_id", "span", *[F.coalesce(agg(c).over(outer), F.lit(0)).alias("o_" + c) for c in columns])
    inner = W.partitionBy("conv_id", "span").orderBy(way("k")).rowsBetween(W.unboundedPreceding, -1)
    df = df.select("conv_id", "k", "span", *[F.coalesce(agg(c).over(inner), F.lit(0)).alias(c) for c in columns])
    return df.join(spans, ["conv_id", "span"]).select("conv_id", "k", *[join(F.col(c), F.col("o_" + c)).alias(c) for c in columns])


def _chunks(spark: SparkSession, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Chunk rows ``conv_id, k, len, p1, p2, z1s, z2s, chars``: turns from ``WIDTH * k`` on, and the name of the node before them.

    A conversation has a row, maybe without turns, for the chunk in which it ends.
    """
    k = F.expr(f"pos div {WIDTH}")
    also = F.when((F.col("pos") % WIDTH == 0) & (F.col("pos") > 0), F.array(k, k - 1)).otherwise(F.array(k))
    turn = F.struct("pos", F.xxhash64("pos", "h1", "h2").alias("z1"), F.xxhash64(F.lit(2), "pos", "h1", "h2").alias("z2"), "chars")
    rows = turns.select("conv_id", "len", turn.alias("t"), F.explode(also).alias("k"))
    ends = convs.select("conv_id", "len", F.lit(None).cast(rows.schema["t"].dataType).alias("t"), F.expr(f"len div {WIDTH}").alias("k"))
    mine = F.when(F.expr(f"t.pos div {WIDTH}") == F.col("k"), F.col("t"))
    rows = rows.unionByName(ends).groupBy("conv_id", "k").agg(  # at most WIDTH + 1 turns a group
        F.max("len").alias("len"), F.sort_array(F.collect_list("t")).alias("ts"),
        F.bit_xor(mine["z1"]).alias("x1"), F.bit_xor(mine["z2"]).alias("x2"))
    rows = written(spark, rows.select("conv_id", "k", "len", "x1", "x2", F.col("ts.z1").alias("z1s"), F.col("ts.z2").alias("z2s"),
                                      F.col("ts.chars").alias("chars")), "trie_chunks")
    long = rows.where(F.col("len") >= WIDTH)
    names = _others(long.select("conv_id", "k", "x1", "x2"), ["x1", "x2"], F.bit_xor, lambda a, b: a.bitwiseXOR(b))
    long = long.drop("x1", "x2").join(names.withColumnsRenamed({"x1": "p1", "x2": "p2"}), ["conv_id", "k"])
    zero = F.lit(0).cast("long")
    return rows.where(F.col("len") < WIDTH).drop("x1", "x2").withColumns({"p1": zero, "p2": zero}).unionByName(long)


# -- one shard ---------------------------------------------------------------

def padded(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix, short rows filled with zeros."""
    off, flat = column.offsets.to_numpy(), column.values.to_numpy()
    size = np.diff(off)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < size[:, None]] = flat[off[0]:off[-1]]
    return out


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


_NODE = ("k long, depth long, n1 long, n2 long, q1 long, q2 long, real boolean, edge boolean, parent_edge boolean, conv_id long, "
         "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, chars long, leaf long, val long, "
         "first_end long, ends string, a1 array<long>, a2 array<long>")
_NAMES = [c.split()[0] for c in _NODE.split(", ")]


def shard_nodes(conv: np.ndarray, k: np.ndarray, length: np.ndarray, p1: np.ndarray, p2: np.ndarray, size: np.ndarray,
                z1: np.ndarray, z2: np.ndarray, chars: np.ndarray) -> Iterator[dict[str, list | np.ndarray]]:
    """The nodes of a shard's chunk rows, column by column, as columns of ``_NODE``.

    Complete nodes have all their columns but what follows the chunk; boundary
    ones (``edge``) count the shard's rows and the complete nodes below them.
    """
    n, w = z1.shape
    order = np.lexsort([conv, *[z[:, j] for j in range(w - 1, -1, -1) for z in (z2, z1)], p2, p1, k])
    conv, k, length, p1, p2, size, z1, z2, chars = (x[order] for x in (conv, k, length, p1, p2, size, z1, z2, chars))
    differs = np.ones((n, w + 1), bool)
    differs[1:, 0] = (k[1:] != k[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
    differs[1:, 1:] = (z1[1:] != z1[:-1]) | (z2[1:] != z2[:-1])
    new = np.logical_or.accumulate(differs, axis=1)
    name1 = np.bitwise_xor.accumulate(np.c_[p1, z1], axis=1)
    name2 = np.bitwise_xor.accumulate(np.c_[p2, z2], axis=1)
    # boundary: as many first turns as a row shares with the shard's first or last row, in the shards' order
    cut = min(w, PATH)
    path = np.where(np.arange(cut) < size[:, None], z1[:, :cut] >> 32, -1 << 40)
    by_path = np.lexsort([*[path[:, j] for j in range(cut - 1, -1, -1)], p2, p1, k])
    shared = np.full(n, -1)
    for e in (by_path[0], by_path[-1]):
        m = np.logical_and.accumulate(path == path[e], axis=1).sum(1)
        m = np.where(m == cut, w + 1, m)  # alike as far as the order looks: maybe further
        shared = np.maximum(shared, np.where((k == k[e]) & (p1 == p1[e]) & (p2 == p2[e]), m, -1))
    starts = [np.flatnonzero(new[:, j]) for j in range(w + 1)]
    lowest = [np.minimum.reduceat(conv, s) for s in starts]
    leaves, saved = np.zeros(n, np.int64), np.zeros(n, np.int64)  # of complete nodes, where they start
    for j in range(w, -1, -1):
        at, count = starts[j], np.diff(np.r_[starts[j], n])
        edge = shared[at] >= j
        real = (j <= WIDTH) & ((j > 0) | (k[at] == 0))
        live = size[at] >= j
        if j < w:
            child = new[:, j + 1] & (size > j)
            inside = child & (shared < j + 1)
            kids = np.where(edge, np.add.reduceat(inside.astype(np.int64), at), np.add.reduceat(child.astype(np.int64), at))
        else:
            kids = np.zeros(len(at), np.int64)
        last = chars[at, j - 1] if j else np.zeros(len(at), np.int64)
        leaf, val = (kids == 0).astype(np.int64), (count - 1) * last
        own = live & real & ~edge
        leaves[at[own]] += leaf[own]
        saved[at[own]] += val[own]
        keep = np.flatnonzero(live & (real | edge))
        if not len(keep):
            continue
        n_leaves, n_saved = np.add.reduceat(leaves, at)[keep], np.add.reduceat(saved, at)[keep]
        over = np.searchsorted(starts[j - 1], at[keep], "right") - 1 if j else np.zeros(len(keep), int)
        parent_edge = shared[at[keep]] >= j - 1 if j else np.zeros(len(keep), bool)
        ending = (length == k * WIDTH + j) & (size >= j)
        ends, first_end, a1, a2 = [], [], [], []
        for i in keep.tolist():
            lo, hi = int(at[i]), int(at[i] + count[i])
            ids = conv[lo:hi][ending[lo:hi]] if real[i] else conv[:0]
            first_end.append(int(ids[0]) if len(ids) else None)
            ends.append((",".join(map(str, ids.tolist())) if edge[i] else _digest(ids)))
            first = 0 if k[lo] == 0 else 1
            a1.append(name1[lo, first:j + 1] if edge[i] and real[i] else None)
            a2.append(name2[lo, first:j + 1] if edge[i] and real[i] else None)
        s = at[keep]
        yield {"k": k[s], "depth": k[s] * WIDTH + j, "n1": name1[s, j], "n2": name2[s, j],
               "q1": name1[s, max(0, j - 1)], "q2": name2[s, max(0, j - 1)], "real": real[keep], "edge": edge[keep],
               "parent_edge": parent_edge, "conv_id": lowest[j][keep],
               "parent_conv_id": pa.array(lowest[j - 1][over] if j else np.zeros(len(keep), np.int64), mask=parent_edge if j else np.ones(len(keep), bool)),
               "n_convs": count[keep], "n_children": kids[keep], "n_leaves": n_leaves, "saved": n_saved, "chars": last[keep],
               "leaf": leaf[keep], "val": val[keep], "first_end": pa.array(first_end, pa.int64()), "ends": ends,
               "a1": pa.array(a1, pa.list_(pa.int64())), "a2": pa.array(a2, pa.list_(pa.int64()))}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one shard; a shard is one partition of about ``SHARD`` rows."""
    rows = [b for b in batches if len(b)]
    if not rows:
        return
    t = pa.Table.from_batches(rows).combine_chunks()
    lists = [t.column(i).combine_chunks() for i in range(5, 8)]
    lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
    size = np.diff(lists[0].offsets.to_numpy())
    wide = int(size.max(initial=0))
    plain = [t.column(i).to_numpy() for i in range(5)]
    for out in shard_nodes(*plain, size, *[padded(x, wide) for x in lists]):
        for lo in range(0, len(out["k"]), 4096):
            cols = [pa.array(out[c][lo:lo + 4096]) if not isinstance(out[c], pa.Array) else out[c][lo:lo + 4096] for c in _NAMES]
            yield pa.RecordBatch.from_arrays(cols, names=_NAMES)


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces of ids, which come in order; only the hash's state is held."""
    now, h, done = None, None, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*[d[0] for d in done])] + [pa.array([d[1] for d in done])],
                                          names=[*_KEY, "sha"])

    for batch in batches:
        for *key, _, ids in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if key != now:
                if now is not None:
                    done.append((now, h.hexdigest()))
                now, h = key, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        if len(done) > 4096:
            yield out()
            done = []
    if now is not None:
        done.append((now, h.hexdigest()))
    if done:
        yield out()


# -- boundary nodes and what follows a chunk ---------------------------------

def _recombined(spark: SparkSession, pieces: DataFrame) -> DataFrame:
    """Boundary nodes from their pieces, with the columns of complete ones."""
    edge = pieces.where("edge")
    whole = edge.groupBy(*_KEY).agg(
        F.first("real").alias("real"), F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("chars").alias("chars"),
        F.first("a1").alias("a1"), F.first("a2").alias("a2"))
    whole = written(spark, whole, "trie_boundary")
    kids = (whole.where(F.col("depth") > F.col("k") * WIDTH)
            .groupBy("k", (F.col("depth") - 1).alias("depth"), F.col("q1").alias("n1"), F.col("q2").alias("n2")).agg(F.count(F.lit(1)).alias("split")))
    whole = whole.join(kids, _KEY, "left").withColumn("n_children", F.col("n_children") + F.coalesce("split", F.lit(0)))
    whole = whole.withColumn("leaf", F.when(F.col("real") & (F.col("n_children") == 0), 1).otherwise(0).cast("long"))
    whole = whole.withColumn("val", F.when(F.col("real"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(0).cast("long"))
    # a boundary node counts for itself and for the (at most WIDTH) nodes above it in its chunk
    up = whole.where("real").select("k", "depth", "leaf", "val", F.posexplode(F.arrays_zip("a1", "a2")).alias("i", "a"), F.size("a1").alias("n"))
    up = up.groupBy("k", (F.col("depth") - F.col("n") + 1 + F.col("i")).alias("depth"), F.col("a.a1").alias("n1"), F.col("a.a2").alias("n2")).agg(
        F.sum("leaf").alias("more_leaves"), F.sum("val").alias("more_saved"))
    whole = whole.join(up, _KEY, "left")
    for c, more in (("n_leaves", "more_leaves"), ("saved", "more_saved")):
        whole = whole.withColumn(c, F.col(c) + F.coalesce(more, F.lit(0)))
    ends = edge.where("real AND first_end IS NOT NULL").select(*_KEY, "first_end", "ends")
    ends = ends.repartition(*_KEY).sortWithinPartitions(*_KEY, "first_end")
    ends = ends.mapInArrow(_joined_digests, "k long, depth long, n1 long, n2 long, sha string")
    whole = whole.join(ends, _KEY, "left").withColumn("ends", F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())))
    return written(spark, whole.drop("a1", "a2", "split", "more_leaves", "more_saved", "sha"), "trie_recombined")


def _following(chunks: DataFrame, nodes: DataFrame) -> DataFrame:
    """``_KEY, more_leaves, more_saved``: what the chunks after a node's own add to its subtree."""
    own = nodes.where("k > 0").groupBy("conv_id", "k").agg(F.sum("leaf").alias("t_leaf"), F.sum("val").alias("t_val"))
    rows = chunks.where(F.col("len") >= WIDTH).select("conv_id", "k").join(own, ["conv_id", "k"], "left")
    rows = rows.select("conv_id", "k", F.coalesce("t_leaf", F.lit(0)).alias("t_leaf"), F.coalesce("t_val", F.lit(0)).alias("t_val"))
    tail = _others(rows, ["t_leaf", "t_val"], F.sum, lambda a, b: a + b, later=True).where("t_leaf <> 0 OR t_val <> 0")
    rows = chunks.select("conv_id", "k", "p1", "p2", "z1s", "z2s").join(tail, ["conv_id", "k"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(7)]
            for kk, p1, p2, z1, z2, leaf, val in zip(*cols):
                first = 0 if kk == 0 else 1
                n1 = np.bitwise_xor.accumulate(np.array([p1, *z1[:WIDTH]], np.int64))[first:]
                n2 = np.bitwise_xor.accumulate(np.array([p2, *z2[:WIDTH]], np.int64))[first:]
                same = np.ones(len(n1), np.int64)
                yield pa.RecordBatch.from_pydict({"k": same * kk, "depth": kk * WIDTH + first + np.arange(len(n1)), "n1": n1, "n2": n2,
                                                  "more_leaves": same * leaf, "more_saved": same * val})

    paths = rows.select("k", "p1", "p2", "z1s", "z2s", "t_leaf", "t_val").mapInArrow(
        task, "k long, depth long, n1 long, n2 long, more_leaves long, more_saved long")
    return paths.groupBy(*_KEY).agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))


def trie(spark: SparkSession, conversations: DataFrame, base: Column | None = None, head: Column | None = None) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of each node.

    ``conversations`` has ``conv_id, turn, role, text``.  With ``base`` and
    ``head`` (expressions over ``conv_id``) conversations are rebuilt first,
    see ``_rebuilt``; a bounded number of them may share a base.
    """
    arrow_batches(spark)
    turns, convs = _rebuilt(spark, conversations, base, head)
    chunks = written(spark, _chunks(spark, turns, convs), "trie_rows")
    shards = max(1, -(-chunks.count() // SHARD))
    path = F.transform(F.slice("z1s", 1, PATH), lambda z: F.shiftright(z, 32).cast("int"))
    rows = chunks.repartitionByRange(shards, "k", "p1", "p2", path, "conv_id")
    pieces = rows.select("conv_id", "k", "len", "p1", "p2", "z1s", "z2s", "chars").mapInArrow(_shards, _NODE)
    pieces = written(spark, pieces, "trie_pieces")
    whole = _recombined(spark, pieces)
    wanted = [*_KEY, "q1", "q2", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "leaf", "val", "ends"]
    inner = pieces.where("NOT edge")
    known = inner.where("NOT parent_edge").select(*wanted, "parent_conv_id")
    # a node's children that do not know it: any share of all nodes
    under = inner.where("parent_edge").select(*wanted).unionByName(whole.where(F.col("real") & (F.col("depth") > F.col("k") * WIDTH)).select(*wanted))
    above = whole.select("k", (F.col("depth") + 1).alias("depth"), F.col("n1").alias("q1"), F.col("n2").alias("q2"),
                         F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("below"))
    found = hot_join(under, above, ["k", "depth", "q1", "q2"], "below", pieces.count())
    root = whole.where(F.col("real") & (F.col("depth") == 0)).select(*wanted, F.lit(None).cast("long").alias("parent_conv_id"))
    nodes = known.unionByName(found.select(*wanted, "parent_conv_id")).unionByName(root)
    if chunks.where("k > 0").limit(1).count():
        nodes = nodes.join(_following(chunks, nodes), _KEY, "left")
        nodes = nodes.withColumn("n_leaves", F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0)))
        nodes = nodes.withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
