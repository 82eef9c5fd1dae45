import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from helpers import awkward, docs
from tokenizers import Tokenizer

from sweepframe.llm import bpe, repair
from sweepframe.llm.spans import Spans

FILE = P.path("word_bpe_49k.json")


def texts():
    rnd = random.Random(1)
    odd = ["".join(chr(rnd.choice([rnd.randrange(1, 0x250), rnd.randrange(0x20, 0x7F), rnd.randrange(0x370, 0xD7FF),
                                   rnd.randrange(0x1F300, 0x1F700)])) for _ in range(150)) for _ in range(150)]
    return [t or "" for _, t in awkward()] + odd + [
        "aaaaaaa aaa aaaa", "<|endoftext|>ab<|startoftext|> <|endoftext|>", "ΣΑΣ ΟΔΟΣ Σ", "İ ǅ ﬁ", "it's we'll 'sab !'s", "\x1c\x85　x\u200b",
        "é e\u0301", "word" * 3000]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(name):
    lib = Tokenizer.from_file(P.path(name))
    encoder = bpe.Encoder(*bpe.load(P.path(name)))
    for t, ids in zip(texts(), encoder.encode(texts())):
        ids = np.frombuffer(ids, "<i4")
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids, t
        if "<|" not in t:
            assert encoder.decode(ids) == lib.decode(ids.tolist(), skip_special_tokens=False)


def test_cache_may_start_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    encoder = bpe.Encoder(*bpe.load(FILE))
    lib = Tokenizer.from_file(FILE)
    for t in texts()[:40]:
        (ids,) = encoder.encode([t])
        assert np.frombuffer(ids, "<i4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_query_columns(spark):
    lib = Tokenizer.from_file(FILE)
    d = docs(spark, awkward(), extra=True)
    out = bpe.encode(spark, d, FILE, "tokens", "back")
    assert out.columns == [*d.columns, "tokens", "back"]
    got = {r.doc_id: r for r in bpe.digests(bpe.encode(spark, docs(spark, awkward()), FILE)).collect()}
    for i, t in awkward():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(spark, docs(spark, []), FILE).count() == 0


def test_library_encoder_equals_whole_texts():
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = repair.LibraryEncoder(f.read())
    for t, ids in zip(texts(), encoder.encode(texts())):
        assert ids.tolist() == encoder.lib.encode(t, add_special_tokens=False).ids, t


def test_spans_follow_the_pattern():
    rnd = random.Random(6)
    cutter, _ = bpe.load(P.path("byte_bpe_50k.json"))
    alphabet = " \t\n'\u00a0sdtmlrve'Aé1²!.  '" + "".join(chr(c) for c in range(0x20, 0x250, 7))
    some = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(2000)] + ["", " ", "'s", "x" * 300, "'" * 70]
    spans = Spans(some)
    h = {}
    for t, a, b in zip(some, spans.first[:-1], spans.first[1:]):
        assert [spans.piece(i) for i in range(a, b)] == cutter.pieces(t), t
    for i, x in enumerate(spans.hashes().tolist()):
        assert h.setdefault(x, spans.piece(i)) == spans.piece(i)
