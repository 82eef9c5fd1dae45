import random
import re

import pyarrow as pa
from helpers import awkward, docs

from sweepframe.llm import licenses as L


def text_words(t):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def places(t):
    w = text_words(t)
    return [(i, label) for p, label in L.BASE_PHRASES.items() for q in [p.split()]
            for i in range(len(w)) if w[i:i + len(q)] == q]


def rows_of(texts, templates=None, phrases=None):
    known = L.Templates(L.TEMPLATES if templates is None else templates, L.BASE_PHRASES if phrases is None else phrases)
    cols = L.scan_column(pa.array(texts, pa.string()), known)
    return [dict(zip([f for f, _ in L.FIELDS], r)) for r in zip(*[c.to_pylist() for c in cols])]


def test_base_phrases_against_brute_force():
    rnd = random.Random(2)
    words = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "CC-BY", "the", "x1", "é"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) for _ in range(300)]
    texts += [t for _, t in awkward()] + ["cc", "cc by", "all rights all rights reserved reserved", "cc\nby", "ccby", "cc éby"]
    for t, r in zip(texts, rows_of(texts)):
        p = places(t)
        where = [i for i, _ in p]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(text_words(t)), len(p), min(where, default=None), max(where, default=None), ",".join(sorted({x for _, x in p})))
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1


def test_matching_statistics_against_brute_force():
    rnd = random.Random(4)
    alphabet = ["a", "b", "c"]
    for _ in range(40):
        texts = [[rnd.choice(alphabet) for _ in range(rnd.randrange(2, 12))] for _ in range(4)]
        known = L.Templates([("t", " ".join(t)) for t in texts], {"a b": "ab"})
        stream = [rnd.choice(["a", "b", "c"]) for _ in range(40)]
        runs = {" ".join(t[i:j]) for t in [*texts, ["a", "b"]] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        state = size = 0
        for i, w in enumerate(stream):
            if w not in known.number:
                state, size = 0, 0
                continue
            state, size = known.auto.step(state, size, known.number[w])
            want = max((n for n in range(1, i + 2) if " ".join(stream[i + 1 - n:i + 1]) in runs), default=0)
            assert size == want
            if size:
                run = stream[i + 1 - size:i + 1]
                ends = {(t, e) for t, seq in enumerate([*texts, ["a", "b"]]) for e in range(size, len(seq) + 1) if seq[e - size:e] == run}
                assert set(known.ends[state]) == ends


def test_templates_are_found_whole_and_with_gaps():
    mit = dict(L.TEMPLATES[::-1])["mit"]
    whole = "x y z released under the MIT license and more"
    broken = " ".join(w if i % 17 else w + " noise" for i, w in enumerate(
        "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the Software to deal in the Software without restriction including without limitation the rights "
        "to use copy modify merge publish distribute sublicense and or sell copies of the Software".split()))
    a, b, c = rows_of([whole, broken, "the software is under a license in the public"])
    assert mit and "mit" in a["labels"].split(",") and a["score"] == 1.0
    span = next(s for s in a["spans"] if s["cover"] == 1.0)
    assert (span["first"], span["end"]) == (3, 8)
    assert "mit" in b["labels"].split(",") and b["score"] >= 0.75
    assert c["labels"] == "" and c["score"] < 0.5


def test_every_copy_of_a_notice_is_a_span():
    """Copies side by side, apart, broken or cut short: each that covers enough is a span, none overlap."""
    notice = "licensed under the Apache License, Version 2.0"  # eight words
    n = len(text_words(notice))
    side, apart, broken, cut, many = rows_of([
        notice + " " + notice, notice + " z" * 40 + " " + notice, notice + " z z " + notice.replace("the Apache", "the z Apache"),
        notice + " z" * 40 + " licensed under the", (notice + " z ") * 2000], [("apache-2.0", notice)], {})

    def spans(r):
        return [(s["first"], s["end"], s["cover"]) for s in r["spans"]]

    assert spans(side) == [(0, n, 1.0), (n, 2 * n, 1.0)]
    assert spans(apart) == [(0, n, 1.0), (n + 40, 2 * n + 40, 1.0)]
    assert spans(broken) == [(0, n, 1.0), (n + 2, 2 * n + 3, 1.0)]
    assert spans(cut) == [(0, n, 1.0)]
    assert spans(many) == [(k * (n + 1), k * (n + 1) + n, 1.0) for k in range(2000)]
    assert {r["labels"] for r in (side, apart, broken, cut, many)} == {"apache-2.0"} and many["score"] == 1.0


def test_scan(spark):
    d = docs(spark, awkward() + [(500, "Licensed under CC BY-NC 4.0.")], extra=True)
    out = L.scan(spark, d)
    assert out.columns[:len(d.columns)] == d.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == d.count()
    assert rows[500].labels == "cc-by,cc-by-nc" and rows[0].labels == "" and rows[0].first_word is None
    assert L.scan(spark, docs(spark, [])).count() == 0
