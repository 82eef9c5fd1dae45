"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow text column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Table(NamedTuple):
    """What words are made of: the lower-cased byte of each byte, and whether it is part of a word."""

    byte: np.ndarray
    inside: np.ndarray


SPACED = Table(_LOWER, ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]))
ALNUM = Table(_LOWER, (np.arange(256) >= 128) | ((_LOWER >= 97) & (_LOWER <= 122)) | ((_LOWER >= 48) & (_LOWER <= 57)))

_ODD = np.random.default_rng(20).integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = np.random.default_rng(21).integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Powers of the words' polynomial; the rest of a very long word is taken this many bytes at a time.
_SPAN = 1 << 12
_POWER = np.cumprod(np.r_[np.uint64(1), np.full(_SPAN, _ODD[0])])


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of ``n`` texts: byte spans in ``data`` (mapped through the table), and where each text's words begin."""

    data: np.ndarray
    text: np.ndarray  # byte offsets of the texts, n + 1
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # index of each text's first word, n + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial over its bytes alone, from the longest words to the shortest."""
        size = self.end - self.start
        order = np.argsort(-size, kind="stable")
        at, left = self.start[order], size[order]
        h = left.astype(np.uint64) * _ODD[1]
        k, live = 0, len(order)
        while True:
            live = int(np.searchsorted(-left[:live], -k, "left"))  # words longer than k
            if not live:
                break
            if k >= 64 and live < 64:  # a few very long words: one by one
                for i in range(live):
                    for lo in range(k, int(left[i]), _SPAN):
                        v = _BYTE[self.data[at[i] + lo:at[i] + min(lo + _SPAN, left[i])]]
                        with np.errstate(over="ignore"):  # the same polynomial, many bytes at once
                            h[i] = h[i] * _POWER[len(v)] + (v * _POWER[len(v) - 1::-1]).sum(dtype=np.uint64)
                break
            h[:live] = h[:live] * _ODD[0] + _BYTE[self.data[at[:live] + k]]
            k += 1
        out = np.empty(len(h), np.uint64)
        out[order] = mix(h)
        return out

    def doc(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def hash_word(word: str, table: Table = ALNUM) -> int:
    """The hash that ``Words.hashes`` gives this word."""
    return int(words(pa.array([word]), table).hashes()[0])


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, null as empty, and the offsets of its texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off - off[0]


def words(column: pa.Array, table: Table) -> Words:
    raw, off = raw_bytes(column)
    data, inside = table.byte[raw], table.inside[raw]
    new = np.zeros(len(data) + 1, bool)
    new[off] = True
    before = np.r_[False, inside[:-1]] if len(inside) else inside
    after = np.r_[inside[1:], False] if len(inside) else inside
    start = np.flatnonzero(inside & (~before | new[:-1]))
    end = np.flatnonzero(inside & (~after | new[1:])) + 1
    return Words(data, off, start, end, np.searchsorted(start, off))


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together."""
    _, off = raw_bytes(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's set of ``n``-word shingles as sorted distinct hashes, and the offsets of the texts.

    A text of fewer words has its whole word sequence as its one shingle; one without words has none.
    """
    wh, first, count = w.hashes(), w.first, w.counts
    out = np.zeros(len(wh), np.uint64)
    many = np.maximum(len(wh) - n + 1, 0)
    for j in range(n):
        out[:many] += wh[j:j + many] * _ODD[8 + j]
    out[:many] += _ODD[7:8] * np.uint64(n)
    real = np.maximum(count - n + 1, np.minimum(count, 1))
    for size in range(1, n):
        at = first[:-1][count == size]
        out[at] = sum((wh[at + j] * _ODD[8 + j] for j in range(size)), np.zeros(len(at), np.uint64)) + _ODD[7:8] * np.uint64(size)
    keep = np.arange(len(wh)) - np.repeat(first[:-1], count) < np.repeat(real, count)
    out = mix(out[keep])
    off = np.r_[0, np.cumsum(real)]
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    fresh = np.r_[True, out[1:] != out[:-1]] if len(out) else np.zeros(0, bool)
    fresh[off[:-1][real > 0]] = True
    return out[fresh], np.r_[0, np.cumsum(fresh)][off]
