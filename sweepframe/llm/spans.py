"""Byte-level pieces of many texts at once: numpy over code points instead of a regular expression.

Follows the pattern ``pieces.BYTE_LEVEL`` for texts of common characters:
runs of letters, of digits and of other signs, each with one space before
it; the endings 's 't 're 've 'm 'll 'd where a quote begins a piece; and
white space, whose last character stays with what follows.
"""

from __future__ import annotations

import numpy as np
import regex

from sweepframe.llm.pieces import _COMMON
from sweepframe.llm.textcore import mix

#: Stands between texts; no text has it.
BREAK = 0xFFFF
_SIGN, _LETTER, _DIGIT, _SPACE, _EDGE = range(5)

_CLASS = np.full(BREAK + 1, _SIGN, np.uint8)
for _cp in _COMMON:
    _CLASS[_cp] = (_LETTER if regex.match(r"\p{L}", chr(_cp)) else _DIGIT if regex.match(r"\p{N}", chr(_cp))
                   else _SPACE if regex.match(r"\s", chr(_cp)) else _SIGN)
_CLASS[BREAK] = _EDGE
_ODD = np.random.default_rng(30).integers(1 << 63, size=4, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODE = np.random.default_rng(31).integers(1 << 63, size=BREAK + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSE = np.uint64(pow(int(_ODD[0]), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n - 1, base)])


#: Characters hashed together; the powers of the polynomial and their inverses are ready for so many, a longer piece makes its own.
_READY = 1 << 17
_POWERS = {base: _powers(base, _READY) for base in (_ODD[0], _INVERSE)}


class Spans:
    """Pieces of texts as spans of ``chars``: ``start``, ``end`` and ``first`` (each text's first piece, n + 1)."""

    def __init__(self, texts: list[str]):
        brk = chr(BREAK)
        self.chars = chars = np.frombuffer((brk + brk.join(texts) + brk).encode("utf-32-le"), np.uint32)
        kind = _CLASS[chars]
        gap = np.flatnonzero(kind == _EDGE)
        new = np.r_[True, kind[1:] != kind[:-1]]  # runs of one class
        space = kind == _SPACE
        blank = chars == 32
        start = new.copy()
        start[1:] &= ~(blank[:-1] & ~space[1:] & (kind[1:] != _EDGE))  # a space goes with the run behind it
        last = space.copy()  # last white space before a run
        last[:-1] &= ~space[1:] & (kind[1:] != _EDGE)
        start |= last
        quote = np.flatnonzero(start & (chars == 39))
        if len(quote):
            one = np.isin(chars[np.minimum(quote + 1, len(chars) - 1)], [ord(c) for c in "stmd"])
            a, b = chars[np.minimum(quote + 1, len(chars) - 1)], chars[np.minimum(quote + 2, len(chars) - 1)]
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            for hit, n in ((one, 2), (two & ~one, 3)):
                start[quote[hit] + 1] = False
                start[quote[hit] + n] = True
        start[gap] = True
        begin = np.flatnonzero(start)
        end = np.r_[begin[1:], len(chars)]
        keep = kind[begin] != _EDGE
        self.start, self.end = begin[keep], end[keep]
        self.first = np.searchsorted(self.start, gap)
        self.first[-1] = len(self.start)

    def hashes(self) -> np.ndarray:
        """A polynomial in each piece's characters, from running sums over many pieces."""
        h = np.empty(len(self.start), np.uint64)
        a = 0
        while a < len(h):
            lo = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, lo + _READY, "right")))
            start, end = self.start[a:b] - lo, self.end[a:b] - lo
            n = int(end[-1])
            up, down = (p[:n] if n <= _READY else _powers(base, n) for base, p in _POWERS.items())
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_CODE[self.chars[lo:lo + n]] * up, out=sums[1:])
            h[a:b] = (sums[end] - sums[start]) * down[start]
            a = b
        return mix(h + (self.end - self.start).astype(np.uint64) * _ODD[1])

    def piece(self, i: int) -> str:
        return self.chars[self.start[i]:self.end[i]].tobytes().decode("utf-32-le")


class KnownPieces:
    """Ids of the pieces met so far: by order of arrival, ``hash`` and where each one's ids lie in ``ids``.

    A table at most half full finds them: the hash's first bits say which
    slot to look at, and the slots behind it follow.
    """

    def __init__(self):
        self.hash = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self._table(12)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is known."""
        if not len(self.hash):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = self._first(h)
        place = self._slot[at]
        known = self.hash[place] == h
        open_ = np.flatnonzero(~known)
        while len(open_):  # until a slot with the hash, or an empty one
            open_ = open_[place[open_] >= 0]
            at[open_] = (at[open_] + 1) & (len(self._slot) - 1)
            place[open_] = self._slot[at[open_]]
            known[open_] = self.hash[place[open_]] == h[open_]
            open_ = open_[~known[open_]]
        return place.astype(np.int64), known & (place >= 0)

    def add(self, h: np.ndarray, ids: list[list[int]]) -> None:
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.append(h, np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum())), size)

    def append(self, h: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """New pieces: their hashes (none twice), their ids one after another, and how many each has."""
        n = len(self.hash)
        self.at = _extended(self.at, len(self.ids) + np.cumsum(size) - size)
        self.size = _extended(self.size, size)
        self.ids = _extended(self.ids, ids)
        self.hash = _extended(self.hash, h)
        if 2 * len(self.hash) > len(self._slot):
            n = 0
            self._table(1 + (2 * len(self.hash)).bit_length())
        at, place = self._first(self.hash[n:]), np.arange(n, len(self.hash), dtype=np.int32)
        while len(place):  # of those that want a slot, one gets it; the others go on
            free = self._slot[at] < 0
            self._slot[at[free]] = place[free]
            rest = self._slot[at] != place
            at, place = (at[rest] + 1) & (len(self._slot) - 1), place[rest]

    def _table(self, bits: int) -> None:
        self._slot = np.full(1 << bits, -1, np.int32)

    def _first(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(65 - len(self._slot).bit_length())).astype(np.int64)


def _extended(a: np.ndarray, more: np.ndarray) -> np.ndarray:
    """``more`` behind ``a``, in the same memory while that has room."""
    n, room = len(a) + len(more), a if a.base is None else a.base
    if len(room) < n:
        room = np.empty(2 * n, a.dtype)
        room[:len(a)] = a
    room[len(a):n] = more
    return room[:n]


def take_spans(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices of the spans ``at .. at + size``, one after another."""
    ends = np.cumsum(size)
    return np.repeat(at - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
