"""Token-id output: shards of ids compressed by a Re-Pair grammar, with random access.

Documents are range-sorted by id; each task encodes its range, appends the
end id to each document and cuts the ids into shards of about ``SHARD_IDS``.
In a shard, frequent pairs of neighbouring symbols are replaced by new
symbols until no pair is frequent; the end id is never part of a pair, so no rule
crosses a document.  Symbols are numbered from the shard's own distinct ids
on, so their width does not depend on the vocabulary.  The rules and the
length each symbol expands to are stored with the shard, so a document, or
any range of ids, is decoded without the rest of it.

Shard format (one Parquet row each, little-endian): ``part, shard, first``
(ids of the part before it), ``doc_ids``, ``n_tokens`` (per document, with
the end id), ``terminals`` (uint32 ids of the first symbols), ``grammar``
(uint32 left and right symbol and expansion length of each rule), ``symbols`` (uint16 while all symbols fit, else uint32), ``cuts``
(symbols up to each document's end) and ``base`` (the first rule's symbol).

Defined results: null text is empty, its document is the end id alone;
documents without an id come first; rows that repeat an id stand in a row;
no rows give no shards.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.llm.common import arrow_batches, maybe_broadcast
from sweepframe.llm.pieces import Cutter, byte_alphabet
from sweepframe.llm.spans import BREAK, KnownPieces, Spans, take_spans
from sweepframe.session import scratch_path

SHARD_IDS = 1 << 19
#: Pairs are replaced until none occurs this often in its shard.
MIN_COUNT = 6
#: Pieces whose ids a worker remembers.
CACHE = 1_000_000
#: Characters cut into pieces at once, and handed to the library's model at once.
GROUP = 1 << 19
CALL = 1 << 12

_BREAK_BYTES = chr(BREAK).encode()
_ODD = np.random.default_rng(8).integers(1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SHARDS = ("part int, shard int, first long, n_ids long, base int, doc_ids array<long>, n_tokens array<int>, "
          "terminals binary, grammar binary, symbols binary, cuts binary")


def compress(ids: np.ndarray, end: int, base: int, least: int = MIN_COUNT,
             room: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Re-Pair: ``(symbols, rules)`` with rule ``i`` standing for symbol ``base + i``.

    Pairs are replaced until none occurs ``least`` times without overlap (or
    until ``room`` rules are used).  A round replaces every occurrence that
    neither overlaps one of a more frequent pair nor belongs to a pair left
    with fewer than ``least`` such occurrences; the most frequent pair always
    goes.  A pair's count never grows once its symbols exist, so only
    ``live`` places are counted again: those of pairs that stayed frequent
    and those next to a replacement.
    """
    sym = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    used = 0
    live = np.flatnonzero((sym[:-1] != end) & (sym[1:] != end))
    while len(live) and (room is None or used < room):
        kind, half = (np.uint32, 16) if base + used <= 1 << 16 else (np.uint64, 32)
        left, right = sym[live].astype(kind), sym[live + 1].astype(kind)
        key = left << kind(half) | right
        even = _without_overlap(live, left == right)
        pairs, count = _count(key if even.all() else key[even])
        often = np.flatnonzero(count >= least)
        pairs, count = pairs[often], count[often]
        if not len(pairs):
            break
        at = _find(pairs, key)
        hit = np.flatnonzero(at >= 0)
        live, at, even = live[hit], at[hit], even[hit]
        where, at = live[even], at[even]
        place = np.empty(len(pairs), np.int64)  # 0 is the most frequent pair
        place[np.argsort(-count, kind="stable")] = np.arange(len(pairs))
        order = place[at]
        loses = np.zeros(len(where), bool)
        beside = where[1:] == where[:-1] + 1
        loses[1:] |= beside & (order[1:] > order[:-1])
        loses[:-1] |= beside & (order[:-1] > order[1:])
        where, at = where[~loses], at[~loses]
        done = np.bincount(at, minlength=len(pairs))
        chosen = np.flatnonzero(done >= least)
        if room is not None and len(chosen) > room - used:
            chosen = np.sort(chosen[np.argsort(-done[chosen], kind="stable")[:room - used]])
        number = np.zeros(len(pairs), np.uint32)
        number[chosen] = base + used + np.arange(len(chosen))
        mine = number[at] > 0
        where, at = where[mine], at[mine]
        rules.append(np.column_stack([pairs[chosen] >> kind(half), pairs[chosen] & kind((1 << half) - 1)]).astype(np.uint32))
        used += len(chosen)
        again = np.zeros(len(sym), bool)
        again[live] = True
        sym[where] = number[at]
        keep = np.ones(len(sym), bool)
        keep[where + 1] = False
        sym, again = sym[keep], again[keep]
        new = where - np.arange(len(where))
        again[new] = True
        again[new[new > 0] - 1] = True
        live = np.flatnonzero(again[:-1])
        live = live[(sym[live] != end) & (sym[live + 1] != end)]
    return sym, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def _without_overlap(live: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Every other place of a run of one symbol; all other places."""
    twin = np.flatnonzero(same)
    out = np.ones(len(live), bool)
    if len(twin):
        first = np.r_[True, np.diff(live[twin]) != 1]
        begin = np.maximum.accumulate(np.where(first, np.arange(len(twin)), 0))
        out[twin] = (np.arange(len(twin)) - begin) % 2 == 0
    return out


def _slots(key: np.ndarray, bits: int) -> np.ndarray:
    """One of ``2 ** bits`` places of a table for each pair; pairs share them."""
    odd, size = (np.uint32(_ODD & np.uint64(0xFFFFFFFF)), 32) if key.dtype == np.uint32 else (_ODD, 64)
    return (key * odd >> key.dtype.type(size - bits)).astype(np.int64)


def _find(pairs: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Index of each key in the sorted ``pairs``, or -1: by a table, and by search where two pairs share a place."""
    bits = min(20, 4 + len(pairs).bit_length())
    table = np.full(1 << bits, -1, np.int32)
    table[_slots(pairs, bits)] = np.arange(len(pairs))
    at = table[_slots(key, bits)]
    some = np.flatnonzero(at >= 0)
    miss = some[np.flatnonzero(pairs[at[some]] != key[some])]
    near = np.minimum(np.searchsorted(pairs, key[miss]), len(pairs) - 1)
    at[miss] = np.where(pairs[near] == key[miss], near, -1)
    return at


def _count(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.sort(key)
    if not len(key):
        return key, np.zeros(0, np.int64)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[first], np.diff(np.r_[first, len(key)])


def lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule expands to; a rule only uses symbols before it."""
    out = np.ones(len(rules), np.int64)
    todo = np.arange(len(rules))
    while len(todo):  # level by level: a rule is ready once both its parts are
        a, b = rules[todo, 0].astype(np.int64) - base, rules[todo, 1].astype(np.int64) - base
        waiting = np.zeros(len(rules), bool)
        waiting[todo] = True
        ready = ~((a >= 0) & waiting[np.maximum(a, 0)]) & ~((b >= 0) & waiting[np.maximum(b, 0)])
        now = todo[ready]
        a, b = a[ready], b[ready]
        out[now] = np.where(a >= 0, out[np.maximum(a, 0)], 1) + np.where(b >= 0, out[np.maximum(b, 0)], 1)
        todo = todo[~ready]
    return out


def expand(sym: np.ndarray, rules: np.ndarray, base: int, length: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for: each level of the rules writes its ids in place.

    Where the rules stand for fewer ids than the symbols, each rule is
    expanded once, and the symbols copy from there.
    """
    length = lengths(rules, base) if length is None else length

    def sizes(s: np.ndarray) -> np.ndarray:
        n = np.ones(len(s), np.int64)
        big = s >= base
        n[big] = length[s[big] - base]
        return n

    def levels(sym: np.ndarray, n: np.ndarray) -> np.ndarray:
        at = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.uint32)
        while len(sym):
            big = sym >= base
            out[at[~big]] = sym[~big]
            rule, at = rules[sym[big] - base].astype(np.int64), at[big]
            sym, at = np.concatenate([rule[:, 0], rule[:, 1]]), np.concatenate([at, at + sizes(rule[:, 0])])
        return out

    sym = sym.astype(np.int64)
    n = sizes(sym)
    if base + length.sum() > n.sum():
        return levels(sym, n)
    ids = np.concatenate([np.arange(base, dtype=np.uint32), levels(np.arange(base, base + len(rules)), length)])
    at = np.concatenate([np.arange(base), base + np.cumsum(length) - length])
    return ids[take_spans(at[sym], n)]


class Shard:
    """A shard as read back: documents, or any range of its ids, by random access."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.terminals = np.frombuffer(row["terminals"], "<u4")
        table = np.frombuffer(row["grammar"], "<u4").reshape(-1, 3)
        self.rules, self.length = table[:, :2], table[:, 2].astype(np.int64)
        cuts = np.frombuffer(row["cuts"], "<u4").astype(np.int64)
        wide = len(cuts) and len(row["symbols"]) == 4 * cuts[-1]
        self.sym = np.frombuffer(row["symbols"], "<u4" if wide else "<u2").astype(np.uint32)
        self.cuts = np.r_[0, cuts]

    def document(self, k: int) -> np.ndarray:
        return self._expand(self.sym[self.cuts[k]:self.cuts[k + 1]])

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids ``lo`` to ``hi`` of the shard, expanding only the symbols that hold them."""
        size = np.ones(len(self.sym), np.int64)
        big = self.sym >= self.base
        size[big] = self.length[self.sym[big] - self.base]
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1
        skip = lo - (ends[a] - size[a]) if a < len(ends) else 0
        return self._expand(self.sym[a:b])[skip:skip + hi - lo]

    def all(self) -> np.ndarray:
        return self._expand(self.sym)

    def _expand(self, sym: np.ndarray) -> np.ndarray:
        return self.terminals[expand(sym, self.rules, self.base, self.length)]


def _pack(part: int, shard: int, first: int, doc_ids: list, sizes: list[int], ids: np.ndarray, end: int, vocab: int) -> dict:
    have = np.zeros(vocab, bool)
    have[ids] = True
    terminals = np.flatnonzero(have)
    base = len(terminals)
    number = np.cumsum(have) - 1
    sym, rules = compress(number[ids], int(number[end]), base)
    # each document's last symbol is its end id; an end id inside a text is told apart by the ids' lengths
    length = np.ones(len(sym), np.int64)
    rule_len = lengths(rules, base)
    big = sym >= base
    length[big] = rule_len[sym[big] - base]
    cuts = np.searchsorted(np.cumsum(length), np.cumsum(sizes)) + 1
    small = base + len(rules) <= 1 << 16
    return {"part": part, "shard": shard, "first": first, "n_ids": len(ids), "base": base, "doc_ids": doc_ids,
            "n_tokens": sizes, "terminals": terminals.astype("<u4").tobytes(),
            "grammar": np.column_stack([rules, rule_len]).astype("<u4").tobytes(),
            "symbols": sym.astype("<u2" if small else "<u4").tobytes(), "cuts": cuts.astype("<u4").tobytes()}


class LibraryEncoder:
    """Whole texts by the tokenizers library's model, each distinct piece once.

    Texts of common characters are cut with numpy, ``GROUP`` characters at a
    time; special tokens and rarer characters go through the library's own
    splitter.
    """

    def __init__(self, spec_text: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        spec = json.loads(spec_text)
        self.cutter = Cutter.of(spec)
        self.lib = Tokenizer.from_str(spec_text)
        alphabet = [*byte_alphabet()]
        self.chars = dict(enumerate(alphabet))
        # the same model for many pieces at once: 0xFF (never in UTF-8) stands for the line end between
        # pieces, which no byte is mapped to; it gets an id of its own
        vocab = spec["model"]["vocab"]
        self.between = max(vocab.values()) + 1
        self.many = Tokenizer.from_str(json.dumps({
            **spec, "added_tokens": [], "normalizer": None, "post_processor": None, "truncation": None, "padding": None,
            "pre_tokenizer": {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Isolated", "invert": False},
            "model": {**spec["model"], "vocab": {**vocab, "\n": self.between}}}))
        self.codes = np.array([*map(ord, alphabet[:255]), ord("\n")], "<u2")
        self.known = KnownPieces()

    def piece_ids(self, piece: str) -> list[int]:
        """A piece is what the library's splitter hands to its model, byte by byte."""
        return [t.id for t in self.lib.model.tokenize(piece.encode().decode("latin-1").translate(self.chars))]

    def pieces_ids(self, spans: Spans, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces of plain texts, one after another, and how many each has."""
        length = spans.end[which] - spans.start[which] + 1
        ids, sizes = [], []
        at = np.cumsum(length) - length
        cuts = np.r_[np.flatnonzero(np.r_[True, np.diff(at // CALL) > 0]), len(which)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if a == b:
                continue
            n = length[a:b]
            chars = spans.chars[take_spans(spans.start[which[a:b]], n)]
            chars[np.cumsum(n) - 1] = BREAK
            raw = chars.tobytes().decode("utf-32-le").encode().replace(_BREAK_BYTES, b"\xff")
            line = self.codes[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")
            found = np.array(self.many.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(found == self.between)
            ids.append(found[found != self.between])
            sizes.append(np.diff(np.r_[-1, ends]) - 1)
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if self.cutter.is_plain(t):
                group.append(i)
                size += len(t)
                if size >= GROUP:
                    self._encode_plain(texts, group, out)
                    group, size = [], 0
            else:
                ids = [[run] if isinstance(run, int) else [x for p in run for x in self.piece_ids(p)] for run in self.cutter.runs(t)]
                out[i] = np.array([x for part in ids for x in part], np.uint32)
        if group:
            self._encode_plain(texts, group, out)
        return out

    def _encode_plain(self, texts: list[str], group: list[int], out: list) -> None:
        spans = Spans([texts[i] for i in group])
        h = spans.hashes()
        place, have = self.known.find(h)
        new = np.flatnonzero(~have)
        if len(new):
            distinct, first = np.unique(h[new], return_index=True)
            if len(self.known.hash) + len(distinct) > CACHE:
                self.known, new = KnownPieces(), np.arange(len(h))
                distinct, first = np.unique(h, return_index=True)
            self.known.append(distinct, *self.pieces_ids(spans, new[first]))
            place[new], _ = self.known.find(h[new])
        at, size = self.known.at[place], self.known.size[place]
        ids = self.known.ids[take_spans(at, size)]
        cuts = np.r_[0, np.cumsum(size)][spans.first]
        for i, a, b in zip(group, cuts[:-1].tolist(), cuts[1:].tolist()):
            out[i] = ids[a:b]


@lru_cache(1)
def shared_encoder(spec_text: str) -> LibraryEncoder:
    """A worker's encoder, kept with the pieces it knows from one task to the next."""
    return LibraryEncoder(spec_text)


def write_shards(spark: SparkSession, docs: DataFrame, vocab: str, path: str, end: int = 2) -> None:
    """Encode ``docs (doc_id, text)`` and write their shards to ``path``, ids ascending over parts and shards.

    One shuffle: the range sort of the texts.  Rows that share an id are
    spread by their row number, so such a group can span tasks.
    """
    arrow_batches(spark)
    with open(vocab, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    stop = np.array([end], np.uint32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        encoder, vocab_size = None, 0
        names: list = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        n = 0

        def out():
            row = _pack(part, shard, first, names, sizes, np.concatenate(held), end, vocab_size)
            return pa.RecordBatch.from_pylist([row], schema=arrow_schema)

        for batch in batches:
            if encoder is None:
                from sweepframe.llm.repair import shared_encoder  # the worker's own module, not this task's copy

                encoder = shared_encoder(spec.value)
                vocab_size = max(encoder.lib.get_vocab(True).values()) + 1
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode([t or "" for t in batch.column(1).to_pylist()])):
                names.append(doc_id)
                sizes.append(len(ids) + 1)
                held += (ids, stop)
                n += sizes[-1]
                if n >= SHARD_IDS:
                    yield out()
                    shard, first, n = shard + 1, first + n, 0
                    names, sizes, held = [], [], []
        if names:
            yield out()

    arrow_schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                              ("base", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int32())),
                              ("terminals", pa.binary()), ("grammar", pa.binary()), ("symbols", pa.binary()), ("cuts", pa.binary())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.monotonically_increasing_id().alias("rid"))
    ranged = rows.repartitionByRange("doc_id", "rid").sortWithinPartitions("doc_id", "rid").select("doc_id", "text")
    ranged.mapInArrow(task, SHARDS).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Decode shards: ``part, first, doc_id, ids array<int>``, ``first`` counting from the part's start."""
    arrow_batches(spark)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Shard(row).all()
                ends = np.r_[0, np.cumsum(row["n_tokens"])]
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array(row["first"] + ends[:-1], pa.int64()),
                     pa.array(row["doc_ids"], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))],
                    names=["part", "first", "doc_id", "ids"])

    return spark.read.schema(SHARDS).parquet(path).mapInArrow(task, "part int, first long, doc_id long, ids array<int>")


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32``."""
    arrow_batches(spark)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Shard(row).all().astype("<u4")
                ends = np.r_[0, np.cumsum(row["n_tokens"])]
                crc = [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(ends[:-1], ends[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array(row["first"] + ends[:-1], pa.int64()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(row["n_tokens"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["part", "first", "doc_id", "n_tokens", "ids_crc32"])

    shards = spark.read.schema(SHARDS).parquet(path)
    parts = part_starts(shards)
    parts = maybe_broadcast(parts, parts.count())
    docs = shards.mapInArrow(task, "part int, first long, doc_id long, n_tokens long, ids_crc32 long")
    return docs.join(parts, "part").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def part_starts(shards: DataFrame) -> DataFrame:
    """Ids before each part: a running sum over one row per part (as many as the writing job had tasks)."""
    from pyspark.sql import Window as W

    sums = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def roundtrip_digests(spark: SparkSession, docs: DataFrame, vocab: str) -> DataFrame:
    path = scratch_path(spark, "repair_shards")
    write_shards(spark, docs, vocab, path)
    return document_digests(spark, path)
