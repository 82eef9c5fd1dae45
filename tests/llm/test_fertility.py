import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sweepframe.llm import fertility as R
from sweepframe.llm.queries import op12_quality_rules, vocabulary

from helpers import awkward, docs, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def vocabularies():
    return R.Vocabularies.read(vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json"))


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in collections.Counter(grams).items() if n > 1}
    rep = {i + j for i, g in enumerate(grams) if g in often for j in range(3)}
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(rep)]


def cut(text):
    """Pieces and measures, straight from the libraries."""
    import sentencepiece
    import tokenizers

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    tk = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    w = WORD.findall(text or "")
    ids = [i for x in w for i in sp.encode(x)]
    if not ids:
        return 0, [None] * 4
    n, chars = len(ids), sum(map(len, w))
    h = -sum(c / n * math.log2(c / n) for c in collections.Counter(ids).values())
    level = sum(len(tk.encode(" " + x, add_special_tokens=False).ids) for x in w)
    return n, [chars / n, chars / level, sum(sp.is_byte(i) for i in ids) / n, h / math.log2(n) if n > 1 else 1.0]


LINES = "a b\na b\n\n \na b\r\nb a\n" + "x y z x y z w\n" * 3 + "tail a b"
TEXTS = [None, "", "\n\n", "a", "a a a a", "a b c a b c", LINES, "# $ | <a> * & % >>", "Ünï ς 漢字 漢字 𝒳 𝒳   　x \x00y",
         "word " * 70, "ab" * 40_000, *[t for _, t in awkward()]]


def test_plain_counts_against_brute_force():
    for texts in (TEXTS, TEXTS[::-1], [t] if (t := TEXTS[5]) else [], []):
        _, _, got, _ = R.counted(pa.array(texts, pa.string()))
        assert [list(map(int, x)) for x in zip(*got)] == [plain(t) for t in texts]


def test_measures_against_the_libraries():
    fertility = R.Fertility(vocabularies())
    for texts in (TEXTS, TEXTS[3:9]):  # the second time from what is remembered
        w, wh, got, _ = R.counted(pa.array(texts, pa.string()))
        total, found = fertility.measure(w, wh, got[1])
        for i, t in enumerate(texts):
            n, want = cut(t)
            assert total[i] == n
            for x, y in zip(found, want):
                assert np.isnan(x[i]) if y is None else x[i] == pytest.approx(y, abs=1e-9)


def test_scripts():
    _, _, _, s = R.counted(pa.array(["abc é", "αβγ", "где", "漢字漢 ab", "", "12 #", "かな", "한글", None]))
    assert [R.SCRIPTS[i] for i in s] == ["latin", "greek", "cyrillic", "han", "none", "none", "kana", "hangul", "none"]


def brute_bands(rows):
    """Bands by group from ``(band, pieces, measures)``."""
    groups = collections.defaultdict(set)
    for band, n, m in rows:
        if n:
            groups[band, int(math.log2(n))].add((n, *m))
    out = {}
    for key, sets in groups.items():
        side = []
        for j in range(4):
            bins = sorted(math.floor(m[1 + j] * R.BINS) for m in sets)
            q1, mid, q3 = (bins[math.ceil(p * len(bins)) - 1] / R.BINS for p in (0.25, 0.5, 0.75))
            s = R.SPREAD * max((q3 - q1) / 1.349, (R.FLOOR * mid, R.FLOOR * mid, R.FALLBACK_FLOOR, R.ENTROPY_FLOOR * mid)[j])
            side.append((mid - s, mid + s))
        out[key] = (len(sets), side)
    return out


def corpus():
    rnd = random.Random(4)
    rows = [(i, sentence(rnd, rnd.randrange(60, 110)), "s") for i in range(90)]
    rows += [(100 + i, rows[0][1], "s") for i in range(80)]  # copies hold almost half
    rows += [(200, "漢" * 300 + " 字" * 60, "s"), (201, "a b c " * 40, "s"), (202, " ".join("%02x" % rnd.randrange(256) for _ in range(150)), "s")]
    return rows + [(300 + i, t) for i, t in awkward()] + [(None, "x y", "s"), (0, rows[0][1], "s")]


def test_query_against_brute_force(spark, tmp):
    rows = corpus()
    df = docs(spark, rows, extra=True)
    df.write.parquet(f"{tmp}/documents.parquet")
    got = op12_quality_rules(spark, tmp).collect()
    assert len(got) == len(rows)
    cuts = {t: cut(t) for _, t, *_ in rows}
    limits = brute_bands([("en", *cuts[t]) for _, t, *_ in rows])
    want = []
    for i, t, *_ in rows:
        n, m = cuts[t]
        p = plain(t)
        failed = p[0] < 50 or 100 * p[4] > 50 * p[0]
        support, side = limits.get(("en", int(math.log2(n))) if n else None, (0, []))
        out = [c for c, x, (a, b) in zip(R.MEASURES, m, side) if support >= R.SUPPORT and not a <= x <= b]
        want.append((-1 if i is None else i, *p, failed, not failed and not out and n > 0))
    have = [(-1 if r.doc_id is None else r.doc_id, *[r[c] for c in R.COUNTS], r.base_failed, r.kept) for r in got]
    assert sorted(have) == sorted(want)
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(90)) <= kept and not {200, 201, 202} & kept


def test_empty_table_language_missing_and_clashing_names(spark):
    empty = docs(spark, [])
    assert R.judged(spark, R.measures(spark, empty, vocabularies())).count() == 0
    df = docs(spark, [(1, "a b"), (2, None), (2, "где где")], extra=True).drop("lang")
    out = R.judged(spark, R.measures(spark, df, vocabularies(), keep=["doc_id", "n_words", "rid"]))
    assert out.columns[:3] == ["doc_id", "n_words", "rid"] and "n_words_" in out.columns
    rows = {(r.doc_id, r.n_words_, r.band) for r in out.collect()}
    assert rows == {(1, 2, "script:latin"), (2, 0, "script:none"), (2, 2, "script:cyrillic")}


def test_few_words_are_cut_at_once():
    """All new words of a megabyte were encoded by one call, which held a kilobyte for each."""
    f, calls = R.Fertility(vocabularies()), []
    lib = f.byte_level

    class Counting:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return lib.encode_batch_fast(texts, **options)

    f.byte_level = Counting()
    texts = [" ".join(f"w{i}" for i in range(k, 10_000, 3)) for k in range(3)]
    w, wh, plain_counts, _ = R.counted(pa.array(texts))
    total, found = f.measure(w, wh, plain_counts[1])
    assert sum(calls) == 10_000 and max(calls) <= 4096
    assert total.tolist() == [cut(t)[0] for t in texts]
    assert np.allclose(np.array(found).T, [cut(t)[1] for t in texts])
