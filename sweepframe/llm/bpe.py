"""BPE encoding and decoding with a pair occurrence index.

Documents are cut into pieces; the distinct pieces that a partition has not
met before are laid out as one chain of symbols, and an index maps each
mergeable pair to all its positions in that chain.  A heap holds the active
ranks: the lowest is applied to all its positions at once, and the pairs
this makes are added to their lists.  Pieces are independent, so each sees
its merges in ascending rank order, as one piece alone would.

Defined results: null and empty text have no ids and decode to ``''``;
special tokens in a text become their ids; other columns pass through;
rows that repeat an id are encoded one by one; no rows give no rows.
Memory: one Arrow batch, its new pieces, and a cache of at most ``CACHE`` pieces.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sweepframe.llm.common import arrow_batches, fresh
from sweepframe.llm.pieces import Cutter, byte_alphabet, distinct, joined

#: Pieces whose ids a task remembers; beyond that it starts anew.
CACHE = 400_000


@dataclass
class Merges:
    """A vocabulary's merges as arrays: pair keys ascending, their ranks and what they make."""

    keys: np.ndarray
    ranks: np.ndarray
    made: np.ndarray  # by rank
    pairs: np.ndarray  # by rank: left and right id
    inner: np.ndarray  # id of each byte
    last: np.ndarray  # id of each byte at a piece's end
    tokens: list[str]
    glue: str | None  # what decoding puts between tokens; None: bytes are decoded

    @classmethod
    def of(cls, spec: dict) -> Merges:
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        both = np.array([[vocab[a], vocab[b]] for a, b in pairs], dtype=np.int64).reshape(-1, 2)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = both[:, 0] << 32 | both[:, 1]
        order = np.argsort(keys, kind="stable")
        chars = byte_alphabet()
        ids = {**vocab, **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        tokens = [""] * (max(ids.values()) + 1)
        for t, i in ids.items():
            tokens[i] = t
        return cls(keys[order], order.astype(np.int64), made, both,
                   np.array([vocab[c] for c in chars], dtype=np.int32),
                   np.array([vocab[c + end] for c in chars], dtype=np.int32), tokens,
                   " " if spec.get("decoder") is None else None)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the vocabulary has no merge for it."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], -1)


class PairIndex:
    """Symbols of many pieces in one chain, and for each active rank the positions of its pair."""

    def __init__(self, merges: Merges, pieces: list[bytes]):
        self.m = merges
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        self.ends = np.cumsum(size)
        self.sym = merges.inner[raw]
        tail = self.ends[size > 0] - 1
        self.sym[tail] = merges.last[raw[tail]]
        n = len(raw)
        self.next = np.arange(1, n + 1, dtype=np.int32)
        self.next[tail] = -1
        self.prev = np.arange(-1, n - 1, dtype=np.int32)
        self.prev[(self.ends - size)[size > 0]] = -1
        self.at: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.add(np.flatnonzero(self.next >= 0))

    def add(self, left: np.ndarray) -> None:
        """Put the pairs that begin at these positions on their lists."""
        rank = self.m.rank_of(self.sym[left], self.sym[self.next[left]])
        left, rank = left[rank >= 0], rank[rank >= 0]
        if not len(left):
            return
        order = np.argsort(rank, kind="stable")
        left, rank = left[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, where in zip(rank[np.r_[0, cuts]].tolist(), np.split(left, cuts)):
            if r in self.at:
                self.at[r].append(where)
            else:
                self.at[r] = [where]
                heapq.heappush(self.active, r)

    def apply(self, rank: int) -> None:
        """Merge the pair of this rank at all its positions, from left to right."""
        a, b = self.m.pairs[rank]
        lists = self.at.pop(rank)
        where = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        after = self.next[where]
        good = (self.sym[where] == a) & (after >= 0)
        good[good] = self.sym[after[good]] == b
        where = where[good]
        if a == b and len(where) > 1:  # aaa: the first pair takes the middle one
            where = np.sort(where)
            keep, taken = [], -1
            for p, q in zip(where.tolist(), self.next[where].tolist()):
                if p != taken:
                    keep.append(p)
                    taken = q
            where = np.array(keep)
        if not len(where):
            return
        gone = self.next[where]
        then = self.next[gone]
        self.sym[where] = self.m.made[rank]
        self.sym[gone] = -1
        self.next[where] = then
        inside = then >= 0
        self.prev[then[inside]] = where[inside]
        before = self.prev[where]
        self.add(np.unique(np.concatenate([before[before >= 0], where[inside]])))

    def run(self) -> list[bytes]:
        """Every piece's ids as little-endian 32-bit integers."""
        while self.active:
            self.apply(heapq.heappop(self.active))
        left = self.sym >= 0
        ids = self.sym[left].astype("<i4").tobytes()
        cuts = np.concatenate([[0], np.cumsum(left)[self.ends - 1] if len(left) else self.ends]) * 4
        return [ids[x:y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


class Encoder:
    """Encodes batches of texts; remembers the pieces it has met."""

    def __init__(self, cutter: Cutter, merges: Merges):
        self.cutter, self.merges = cutter, merges
        self.known: dict[str, bytes] = {}
        self.names: dict[bytes, str] = {}

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        runs = [self.cutter.runs(t) for t in texts]
        met = distinct(runs)
        new = [p for p in met if p not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known, new = {}, list(met)
        if new:
            self.known.update(zip(new, PairIndex(self.merges, [p.encode() for p in new]).run()))
        known = self.known.__getitem__
        return [joined(doc, known) for doc in runs]

    def decode(self, ids: np.ndarray) -> str:
        tokens = self.merges.tokens
        if self.merges.glue is not None:
            return self.merges.glue.join([tokens[i] for i in ids.tolist()])
        back = {c: b for b, c in enumerate(byte_alphabet())}
        return bytes(back[c] for i in ids.tolist() for c in tokens[i]).decode("utf-8", "replace")


def load(path: str) -> tuple[Cutter, Merges]:
    """Read a tokenizer file on the driver; the tables (some 50,000 entries) travel with the tasks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    return Cutter.of(spec), Merges.of(spec)


def encode(spark: SparkSession, docs: DataFrame, vocab: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with every whole ``text`` as ``ids array<int>`` and decoded again as ``decoded string``.

    ``vocab`` is a tokenizer file's path, read on the driver.  No shuffle:
    each task encodes its own partition.
    """
    arrow_batches(spark, records=512)  # pieces of a batch are held as strings
    tables = spark.sparkContext.broadcast(load(vocab))
    ids, decoded = fresh(docs, ids), fresh(docs, decoded)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*tables.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            out = encoder.encode(texts)
            size = np.fromiter(map(len, out), np.int64, len(out)) // 4
            values = np.frombuffer(b"".join(out), "<i4")
            ends = np.concatenate([[0], np.cumsum(size)])
            back = [encoder.decode(values[x:y]) for x, y in zip(ends[:-1], ends[1:])]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(back, pa.string())],
                                             names=[*names, ids, decoded])

    names, at = docs.columns, docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded, T.StringType())])
    return docs.mapInArrow(task, schema)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by single spaces."""
    return F.sha2(F.concat_ws(" ", ids.cast("array<string>")).cast("binary"), 256)


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digests(encoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what ``encode`` returns."""
    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                          ids_digest(F.col("ids")).alias("ids_sha256"), text_digest(F.col("decoded")).alias("decoded_sha256"))
