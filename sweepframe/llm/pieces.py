"""Cutting text into the pieces that a BPE vocabulary's merges work on.

Covers the two kinds of tokenizer file used here: byte-level with leading
spaces, and lower-case words with an end-of-word suffix.  Text whose
characters every Unicode version classes alike goes through ``regex``;
other text, and final sigmas, through the tokenizer file's own normaliser and
splitter, which this module only configures.  The plain path uses ``re``
with the pattern's classes written out for those characters, which is the
faster of the two engines.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import regex

#: The splitting pattern of byte-level files (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Latin, its accents and common punctuation; other characters are rare.
_COMMON = [*range(0x370), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]


def _chars(points) -> str:
    """A character class's inside, as ranges."""
    spans: list[list[int]] = []
    for p in points:
        if spans and spans[-1][1] == p - 1:
            spans[-1][1] = p
        else:
            spans.append([p, p])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in spans)


_RARE = re.compile(f"[^{_chars(_COMMON)}]")


def plain_pattern(pattern: str) -> str:
    """The pattern for ``re``, with its Unicode classes spelt out for the common characters."""
    inside = {n: _chars(p for p in _COMMON if regex.match(n, chr(p))) for n in (r"\p{L}", r"\p{N}", r"\s")}
    out, bracket = [], False
    for part in re.findall(r"\\p\{[LN]\}|\\[sS]|.", pattern, re.S):
        bracket = part == "[" or (bracket and part != "]")
        if part in inside:
            out.append(inside[part] if bracket else f"[{inside[part]}]")
        else:
            out.append(f"[^{inside[r'\s']}]" if part == r"\S" else part)
    return "".join(out)


@dataclass
class Cutter:
    """Built from a tokenizer file's JSON text; picklable, so it travels to tasks."""

    config: str
    lower: bool
    pattern: str
    specials: tuple[tuple[str, int], ...]

    @classmethod
    def of(cls, spec: dict) -> Cutter:
        words = spec["model"].get("end_of_word_suffix") is not None
        split = next((p["pattern"]["Regex"] for p in (spec["pre_tokenizer"].get("pretokenizers") or [])
                      if p["type"] == "Split"), BYTE_LEVEL)
        bare = {**spec, "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}
        return cls(json.dumps(bare), words, split,
                   tuple((t["content"], t["id"]) for t in spec["added_tokens"] if t["special"]))

    def __post_init__(self):
        self._plain = re.compile(plain_pattern(self.pattern))
        self._special = regex.compile("|".join(regex.escape(s) for s, _ in self.specials)) if self.specials else None
        self._ids = dict(self.specials)
        self._own = None

    def __getstate__(self):
        return {k: getattr(self, k) for k in ("config", "lower", "pattern", "specials")}

    def __setstate__(self, state):
        self.__init__(**state)

    def _exact(self, text: str) -> list[str]:
        if self._own is None:
            from tokenizers import Tokenizer

            self._own = Tokenizer.from_str(self.config)
        if self._own.normalizer:
            text = self._own.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self._own.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text without special tokens."""
        if not text:
            return []
        if not text.isascii() and _RARE.search(text):
            return self._exact(text)
        if self.lower:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            text = text.lower()
        return self._plain.findall(text)

    def is_plain(self, text: str) -> bool:
        """No special token in it, and no rare character."""
        return (text.isascii() or not _RARE.search(text)) and not any(s in text for s in self._ids)

    def runs(self, text: str) -> list[list[str] | int]:
        """Lists of pieces, with the ids of special tokens between them."""
        if not any(s in text for s in self._ids):
            return [self.pieces(text)]
        out, at = [], 0
        for m in self._special.finditer(text):
            out += [self.pieces(text[at:m.start()]), self._ids[m.group()]]
            at = m.end()
        return [*out, self.pieces(text[at:])]


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(kept)))}
    return [chr(moved.get(b, b)) for b in range(256)]


def distinct(runs: list[list[list[str] | int]]) -> set[str]:
    """The distinct pieces of several texts' runs."""
    return set().union(*[run for doc in runs for run in doc if not isinstance(run, int)])


def joined(doc: list[list[str] | int], ids: Callable[[str], bytes]) -> bytes:
    """A text's ids, as little-endian 32-bit integers, from its pieces'."""
    if len(doc) == 1 and not isinstance(doc[0], int):
        return b"".join(map(ids, doc[0]))
    return b"".join(run.to_bytes(4, "little") if isinstance(run, int) else b"".join(map(ids, run)) for run in doc)
