"""Licence scans: matching statistics against a generalised suffix automaton of licence templates.

The automaton accepts every run of words of every template.  A text's
words are streamed through it; at each word it tells the longest run ending
there that some template contains.  Words whose neighbours never stand
together in a template cannot extend a run, so only stretches of known
word pairs are streamed.  Runs that cannot grow are matches; long ones are
chained, template by template, in the order of both text and template, and
chains become covered spans: the best of each template, and every other that
overlaps none given before and covers ``COVER`` of the template.  A template
whose best chain covers so much labels the text; the score is the best cover
of any template.

Base phrases are templates too: the states that end in a phrase are marked,
so each place of a phrase is seen while streaming.

Defined results: null text is empty; a text without words or matches has no
labels (``''``), null places and score 0; other columns pass through
``scan``; rows are independent, so repeated ones get equal results.
Memory: one chunk of text; the automaton is built on the driver from the
templates and travels with the tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sweepframe.llm import textcore as tc
from sweepframe.llm.common import arrow_batches, fresh

#: Phrases whose every place is reported, and their labels (fixed values).
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licence statements and notices, by label (fixed values).
TEMPLATES = [
    ("mit", "released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache-2.0", "licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "licensed under CC BY 4.0"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]

#: Shortest run that joins a chain (shorter templates: all of it).
MIN_RUN = 3
#: Share of a template that its chain must cover to label the text.
COVER = 0.75
#: Words between two runs of a chain, at most, in text and in template.
MAX_GAP = 12


def text_words(text: str) -> list[str]:
    w = tc.words(pa.array([text]), tc.ALNUM)
    return [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)]


@dataclass
class Automaton:
    """Generalised suffix automaton over the word numbers of several templates."""

    go: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])

    def _state(self, size: int, go: dict[int, int], link: int) -> int:
        self.go.append(go)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """A copy of ``q`` for the runs no longer than ``p``'s plus the word."""
        copy = self._state(self.size[p] + 1, dict(self.go[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.go[p].get(word) == q:
            self.go[p][word] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, word: int) -> int:
        """Add one word after state ``last``; the state of the longer run."""
        if word in self.go[last]:  # another template has been here
            q = self.go[last][word]
            return q if self.size[q] == self.size[last] + 1 else self._split(last, word, q)
        new = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.go[p]:
            self.go[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.go[p][word]
            self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, word, q)
        return new

    def step(self, state: int, size: int, word: int) -> tuple[int, int]:
        """Longest known run that ends with ``word``, after the run ``(state, size)``."""
        while state and word not in self.go[state]:
            state = self.link[state]
            size = self.size[state]
        if word in self.go[state]:
            return self.go[state][word], size + 1
        return 0, 0


class Templates:
    """The automaton with what its states stand for."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        texts = [text_words(t) for _, t in templates] + [text_words(p) for p in phrases]
        self.labels = [label for label, _ in templates] + list(phrases.values())
        self.n_words = [len(t) for t in texts]
        self.number = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
        seqs = [[self.number[w] for w in t] for t in texts]
        self.auto = a = Automaton()
        ends: dict[int, set[tuple[int, int]]] = {}
        for seq in seqs:
            last = 0
            for w in seq:
                last = a.extend(last, w)
        phrase_at: dict[int, list[tuple[int, str]]] = {}
        for t, seq in enumerate(seqs):
            state = 0
            for i, w in enumerate(seq):
                state = a.go[state][w]
                ends.setdefault(state, set()).add((t, i + 1))
            if t >= len(templates) and seq:
                phrase_at.setdefault(state, []).append((len(seq), self.labels[t]))
        for s in sorted(range(1, len(a.size)), key=lambda s: -a.size[s]):  # shorter runs end where longer ones do
            if a.link[s] > 0:
                ends.setdefault(a.link[s], set()).update(ends.get(s, ()))
        self.ends = {s: sorted(e) for s, e in ends.items()}
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in a.size]
        for s in sorted(range(1, len(a.size)), key=lambda s: a.size[s]):
            self.phrases[s] = phrase_at.get(s, []) + (self.phrases[a.link[s]] if a.link[s] > 0 else [])
        v = len(self.number) + 1
        self.pair = np.zeros((v, v), bool)  # word pairs that stand together somewhere
        self.whole = np.zeros((v, v), bool)  # pairs that are a whole template
        for seq in seqs:
            for x, y in zip(seq, seq[1:]):
                self.pair[x, y] = True
            if len(seq) == 2:
                self.whole[seq[0], seq[1]] = True
        hashed = sorted((tc.hash_word(w), i) for w, i in self.number.items())
        self.hashes = np.array([h for h, _ in hashed], np.uint64)
        self.numbers = np.array([i for _, i in hashed])
        self.single = any(len(s) == 1 for s in seqs)

    def word_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Template word of each hash; the last number stands for all other words."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], len(self.number))

    def stretches(self, w: tc.Words) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Word numbers, and the word ranges that could hold a long run or a phrase."""
        num = self.word_numbers(w.hashes())
        if len(num) == 0:
            return num, []
        known = num < len(self.number)
        pair = np.r_[self.pair[num[:-1], num[1:]], False]
        pair[w.first[1:][w.counts > 0] - 1] = False  # not across texts
        if self.single:
            begin = np.flatnonzero(known & ~np.r_[False, pair[:-1]])
        else:
            begin = np.flatnonzero(pair & ~np.r_[False, pair[:-1]])
        stop = np.flatnonzero(~pair)
        end = stop[np.searchsorted(stop, begin)] + 1
        two = end - begin == 2
        keep = (end - begin > 2) | (two & self.whole[num[begin], num[np.minimum(begin + 1, len(num) - 1)]])
        if self.single:
            keep |= known[begin]
        return num, list(zip(begin[keep].tolist(), end[keep].tolist()))

    def stream(self, num: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, str]]]:
        """Matching statistics of a stretch: runs that end there ``(start, end, state)``, and places of base phrases."""
        runs, places, state, size = [], [], 0, 0
        for i, w in enumerate(num):
            s, n = self.auto.step(state, size, w)
            if n <= size and size:
                runs.append((i - size, i, state))
            for length, label in self.phrases[s]:
                if length <= n:
                    places.append((i + 1 - length, label))
            state, size = s, n
        if size:
            runs.append((len(num) - size, len(num), state))
        return runs, places

    def chain(self, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Chains of each template: ``(template, first word, end, words covered)``.

        The best one, and then each next best that overlaps none before it and covers ``COVER`` of the template.
        """
        by: dict[int, list[tuple[int, int, int]]] = {}
        for a, b, state in runs:
            for t, e in self.ends[state]:
                n = min(b - a, e)
                if n >= min(MIN_RUN, self.n_words[t]):
                    by.setdefault(t, []).append((a, b, e))
        out = []
        for t, found in by.items():
            out += [(t, start, end, min(cover, self.n_words[t])) for start, end, cover in self._chains(t, found)]
        return sorted(out)

    def _chains(self, t: int, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
        """``chain`` for one template, whose runs come by their ends (and so by their starts)."""
        best: list[tuple[int, int]] = []  # words covered and first word of the best chain ending with each run
        taken = [False] * len(found)  # runs that overlap a chain already given; no chain passes them

        def ending(k: int) -> tuple[int, int]:
            a, b, e = found[k]
            cover, start = b - a, a
            for j in range(k - 1, -1, -1):
                a2, b2, e2 = found[j]
                if taken[j]:
                    break
                if a - b2 > MAX_GAP:
                    if b2 < a - MAX_GAP - self.n_words[t]:
                        break
                    continue
                lap = max(0, b2 - a, e2 - (e - (b - a)))  # words that both would cover
                if e2 < e and b2 < b and e - (b - a) - e2 <= MAX_GAP and lap < b - a and best[j][0] + b - a - lap > cover:
                    cover, start = best[j][0] + b - a - lap, best[j][1]
            return cover, start

        for k in range(len(found)):
            best.append(ending(k))
        heap = [(-c, s, -found[k][1], k) for k, (c, s) in enumerate(best)]
        heapq.heapify(heap)
        first = True
        while heap:
            cover, start, end, k = heapq.heappop(heap)
            cover, end = -cover, -end
            if taken[k] or best[k] != (cover, start):
                continue
            if not first and cover < COVER * self.n_words[t]:
                return
            first = False
            yield start, end, cover
            j = k
            while j >= 0 and found[j][1] > start:
                taken[j] = True
                j -= 1
            j = k + 1
            while j < len(found) and found[j][0] < end:
                taken[j] = True
                j += 1
            reach = end + self.n_words[t] * (self.n_words[t] + MAX_GAP)  # no chain is longer than this
            while j < len(found) and not taken[j] and found[j][0] < reach:
                if best[j][1] < end:  # it began in what is taken, or before
                    best[j] = ending(j)
                    heapq.heappush(heap, (-best[j][0], best[j][1], -found[j][1], j))
                j += 1


SPANS = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("cover", T.DoubleType())]))
FIELDS = [("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
          ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("spans", SPANS)]
_ARROW = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(),
                             pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("cover", pa.float64())]))]


def scan_column(column: pa.Array, known: Templates) -> list[pa.Array]:
    """The columns of ``FIELDS`` for a text column."""
    out: list[list] = [[] for _ in FIELDS]
    for lo, hi in tc.chunks(column):
        w = tc.words(column.slice(lo, hi - lo), tc.ALNUM)
        num, ranges = known.stretches(w)
        of_text: dict[int, list[tuple[int, int]]] = {}
        for (a, b), t in zip(ranges, np.searchsorted(w.first, [a for a, _ in ranges], "right") - 1 if ranges else []):
            of_text.setdefault(int(t), []).append((a, b))
        counts = w.counts.tolist()
        for t in range(hi - lo):
            runs, places = [], []
            for a, b in of_text.get(t, ()):
                at = a - int(w.first[t])
                r, p = known.stream(num[a:b].tolist())
                runs += [(x + at, y + at, s) for x, y, s in r]
                places += [(x + at, label) for x, label in p]
            spans = [(known.labels[k], a, b, cover / known.n_words[k]) for k, a, b, cover in known.chain(runs)] if runs else []
            base = {label for _, label in places}
            where = [x for x, _ in places]
            row = (counts[t], len(places), min(where, default=None), max(where, default=None), ",".join(sorted(base)),
                   ",".join(sorted(base | {s[0] for s in spans if s[3] >= COVER})), max((s[3] for s in spans), default=0.0),
                   [dict(zip(("label", "first", "end", "cover"), s)) for s in spans])
            for col, v in zip(out, row):
                col.append(v)
    return [pa.array(col, kind) for col, kind in zip(out, _ARROW)]


def scan(spark: SparkSession, docs: DataFrame, templates: list[tuple[str, str]] | None = None,
         phrases: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with, for every whole ``text``, the columns of ``FIELDS``; no shuffle."""
    arrow_batches(spark)
    known = spark.sparkContext.broadcast(Templates(TEMPLATES if templates is None else templates,
                                                   BASE_PHRASES if phrases is None else phrases))
    names, at = docs.columns, docs.columns.index("text")
    new = [fresh(docs, n) for n, _ in FIELDS]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *scan_column(batch.column(at), known.value)], names=[*names, *new])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *[T.StructField(n, k) for n, (_, k) in zip(new, FIELDS)]]))
