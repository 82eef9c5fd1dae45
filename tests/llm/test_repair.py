import zlib

import numpy as np
import public_tokenizers as P
import pytest
from helpers import awkward, docs
from tokenizers import Tokenizer

from sweepframe.llm import repair as R
from sweepframe.llm import spans as S
from sweepframe.session import scratch_path

FILE = P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("base,room", [(10, None), (50257, None), (70000, 500), (10, 3)])
def test_grammar_round_trip(base, room):
    rnd = np.random.default_rng(base)
    for ids in (np.zeros(0, int), np.array([2]), np.repeat(5, 999), np.tile([4, 5, 4, 5, 6], 300),
                rnd.integers(0, 9, 5000), np.r_[rnd.integers(3, 9, 50), 2, 2, rnd.integers(3, 9, 50), 2]):
        sym, rules = R.compress(ids, 2, base, room=room)
        assert R.expand(sym, rules, base).tolist() == ids.tolist()
        length = R.lengths(rules, base)
        assert [len(R.expand(np.array([base + i]), rules, base)) for i in range(len(rules))] == length.tolist()
        assert not (rules == 2).any()
        if room:
            assert len(rules) <= room
    assert len(R.compress(np.tile([4, 5, 4, 5, 6], 300), 2, 10)[0]) < 400


def test_random_access():
    rnd = np.random.default_rng(7)
    sizes = [int(n) for n in rnd.integers(1, 400, 30)]
    parts = [np.r_[np.tile(rnd.integers(0, 20, 7), 60)[:n - 1], 2] for n in sizes]
    ids = np.concatenate(parts)
    shard = R.Shard(R._pack(0, 0, 0, list(range(30)), sizes, ids, 2, 50257))
    for k, p in enumerate(parts):
        assert shard.document(k).tolist() == p.tolist()
    for _ in range(50):
        lo, hi = sorted(rnd.integers(0, len(ids) + 1, 2).tolist())
        assert shard.ids(lo, hi).tolist() == ids[lo:hi].tolist()


def want(rows):
    lib, start, out = Tokenizer.from_file(FILE), 0, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_against_library(spark, monkeypatch):
    monkeypatch.setattr(R, "SHARD_IDS", 3000)
    rows = awkward()[::-1]
    got = sorted(tuple(r) for r in R.roundtrip_digests(spark, docs(spark, rows, extra=True), FILE).collect())
    assert got == want(rows)


def test_ids_are_read_back(spark):
    path = scratch_path(spark, "test_shards")
    R.write_shards(spark, docs(spark, [(2, "b # b"), (1, None), (None, "x")]), FILE, path)
    got = {r.doc_id: list(r.ids) for r in R.read_documents(spark, path).collect()}
    lib = Tokenizer.from_file(FILE)
    assert got == {1: [2], 2: lib.encode("b # b").ids + [2], None: lib.encode("x").ids + [2]}


def test_empty(spark):
    assert R.roundtrip_digests(spark, docs(spark, []), FILE).count() == 0


def frequent(sym, end):
    """Largest count of a pair without overlap, over pairs without the end id."""
    counts, taken = {}, {}
    for i, pair in enumerate(zip(sym[:-1], sym[1:])):
        if end not in pair and taken.get(pair, -2) != i - 1:
            counts[pair] = counts.get(pair, 0) + 1
            taken[pair] = i
    return max(counts.values(), default=0)


@pytest.mark.parametrize("base", [50257, 70000])
def test_no_frequent_pair_is_left(base):
    rnd = np.random.default_rng(base)
    text = rnd.integers(3, base, 1000)
    copies = np.concatenate([np.r_[text, 2]] * 100)
    rare = np.r_[rnd.integers(3, base, 70_000), np.tile(np.arange(3, base), 1)]
    runs = np.concatenate([np.r_[np.repeat(7, n), 2] for n in rnd.integers(1, 300, 200)])
    mixed = np.minimum(rnd.geometric(0.02, 30_000) + 2, base - 1)
    for ids in (copies, rare, runs, mixed, np.r_[copies, runs, mixed]):
        sym, rules = R.compress(ids, 2, base)
        assert frequent(sym.tolist(), 2) < R.MIN_COUNT
        assert np.array_equal(R.expand(sym, rules, base), ids)
    assert len(R.compress(copies, 2, base)[0]) == 200  # a symbol for the text, and the end id


def test_wide_symbols():
    """A shard of more than 2^16 distinct ids keeps its rules, and is read back by random access."""
    ids = np.r_[np.arange(70_000), np.tile([9, 8, 7], 50), 2]
    row = R._pack(0, 0, 0, [1], [len(ids)], ids, 2, 70_000)
    shard = R.Shard(row)
    assert len(shard.rules) and len(row["symbols"]) == 4 * len(shard.sym)
    assert np.array_equal(shard.document(0), ids) and np.array_equal(shard.ids(69_990, 70_020), ids[69_990:70_020])


def test_many_pieces_at_once_equal_the_library():
    enc, lib = R.LibraryEncoder(open(FILE, encoding="utf-8").read()), Tokenizer.from_file(FILE)
    texts = ["", "\x00\x00 a\x00b", "\n\n x\n", "ÿþ é€ ÿ", " " * 5000, "x" * (R.CALL + 10), "don't I'll 12 34\t\r\n", "Ċ Ġ"] * 2
    texts += ["".join(chr(c) for c in np.random.default_rng(s).integers(0, 0x370, 3000)) for s in range(20)]
    for got, text in zip(enc.encode(texts), texts):
        assert got.tolist() == lib.encode(text, add_special_tokens=False).ids


def test_known_pieces_stay_in_place():
    """Pieces met later move none of those before, also where all want the same slot."""
    rnd = np.random.default_rng(3)
    every = np.unique(np.r_[rnd.integers(0, 1 << 63, 9000, dtype=np.uint64), np.arange(1000, dtype=np.uint64), np.uint64((1 << 64) - 1)])
    rnd.shuffle(every)
    known, met = S.KnownPieces(), np.zeros(0, np.uint64)
    assert not known.find(every)[1].any()
    for h in np.split(every, [1, 2, 500, 500, 4000, 7000]):
        before = known.find(met)
        size = (h % np.uint64(4)).astype(np.int64)
        known.append(h, np.repeat(h.astype(np.uint32), size), size)
        assert not len(met) or np.array_equal(known.find(met)[0], before[0])
        met = np.r_[met, h]
        place, have = known.find(every)
        assert have.tolist() == np.isin(every, met).tolist()
        assert np.array_equal(known.hash[place[have]], every[have])
        ids = known.ids[S.take_spans(known.at[place[have]], known.size[place[have]])]
        assert np.array_equal(ids, np.repeat(every[have].astype(np.uint32), known.size[place[have]]))


def test_a_piece_has_one_hash_wherever_it_stands():
    words = ["a", "ab", "ba", "b" * 70, "c" * 40_000, "c" * 40_001, "d" * (S._READY + 1), "é"]
    alone = {w: int(S.Spans([w]).hashes()[0]) for w in words}
    assert len(set(alone.values())) == len(words)
    for texts in (["\n".join(words)], ["1" * 999, *words[::-1]], ["2" * S._READY, *words], []):
        spans = S.Spans(texts)
        got = dict(zip(map(spans.piece, range(len(spans.start))), spans.hashes().tolist()))
        assert {w: got[w] for w in words if w in got} == (alone if texts else {})


def test_symbols_are_copied_from_the_rules_or_expanded_by_levels():
    """A symbol of many ids is opened once, however often it stands."""
    rnd = np.random.default_rng(5)
    ids = np.concatenate([np.r_[rnd.integers(3, 20, 64), 2]] * 200)
    sym, rules = R.compress(ids, 2, 20)
    length = R.lengths(rules, 20)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    assert np.array_equal(R.expand(sym, rules.view(Counted), 20, length), ids)
    assert sum(n for n in seen) <= 2 * length.sum()
    for k in (0, 1, 5, len(sym)):
        assert np.array_equal(R.expand(sym[:k], rules, 20, length), ids[:sum(length[s - 20] if s >= 20 else 1 for s in sym[:k])])
