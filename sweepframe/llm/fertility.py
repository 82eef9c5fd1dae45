"""Quality rules on how public tokenisers cut a text, with rejection bands per language or script.

Each white-space word is encoded on its own by a piece vocabulary with byte
fallback (sentencepiece) and, with a space before it, by a byte-level
vocabulary (tokenizers); a task encodes each distinct word once.  Of a text's
words this gives characters per piece, characters per byte-level token, the
share of byte-fallback pieces, and the entropy of its pieces as a share of
the largest it could have.  Texts are grouped by language (by main script
where that is unknown) and by doublings of their number of pieces, since
entropy depends on length.  A group's band is its median plus or minus
``SPREAD`` robust standard deviations (from the quartiles, with a least one
as a share of the median), each distinct set of measures counted once so that copies do
not move it.  Medians come from counts per ``1 / BINS``: exact, the same in
each run, over all documents.  Groups of fewer than ``SUPPORT`` distinct
texts reject nothing.

Plain counts (words, characters, symbols, repeated lines and words) come from
numpy over the texts' bytes.  Lines and word windows are compared by 64-bit
hashes within their own text.

Defined results: null text reads as empty; a text with fewer than
``MIN_WORDS`` words (an empty one too), or with repeated windows over more
than ``REPEATED`` percent of its words, fails the base rules; a text whose
words give no piece at all is outside its band; null ids and repeated rows
give a row each; no rows give no rows; columns to keep are named by the
caller, and names that clash get a trailing underscore.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sweepframe.llm.common import arrow_batches, fresh, maybe_broadcast, written
from sweepframe.llm.spans import KnownPieces, take_spans
from sweepframe.llm.textcore import SPACED, Table, Words, chunks, mix, raw_bytes, words

#: Base rules: words at least, and percent of words in repeated windows at most.
MIN_WORDS, REPEATED = 50, 50
#: Words of a window that is looked for twice.
WINDOW = 3
#: Robust standard deviations of a band to each side, and the least one: a share of the median for
#: characters and for entropy, a plain number for byte fallback, whose median is mostly 0.
SPREAD, FLOOR, ENTROPY_FLOOR, FALLBACK_FLOOR = 5, 0.01, 0.03, 0.02
#: Distinct texts that a group must have to reject any.
SUPPORT = 50
#: Steps of a measure's counts to one.
BINS = 1000
#: Distinct words that a worker remembers, and words cut by one library call: each word's
#: encoding holds about a kilobyte until its tokens are counted.
CACHE, CALL = 1_000_000, 1 << 12
#: A normal distribution's quartiles are this many standard deviations apart.
_QUARTILES = 1.349

_BYTES = np.arange(256, dtype=np.uint8)
#: Words as they are, and lines.
EXACT, LINES = Table(_BYTES, SPACED.inside), Table(_BYTES, _BYTES != 10)
_LEAD = (_BYTES & 0xC0) != 0x80  # bytes that begin a code point
_SYMBOL = np.isin(_BYTES, np.frombuffer(b"#*$%&|<>", np.uint8))
_ODD = np.random.default_rng(40).integers(1 << 63, size=WINDOW + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Scripts by the first byte of a code point in UTF-8.
SCRIPTS = ("none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul", "other")
_SCRIPT = np.full(256, SCRIPTS.index("other"), np.uint8)
_SCRIPT[:0xC0] = 0
for _a, _b, _s in ((0x41, 0x5B, "latin"), (0x61, 0x7B, "latin"), (0xC3, 0xCA, "latin"), (0xCE, 0xD0, "greek"), (0xD0, 0xD4, "cyrillic"),
                   (0xD7, 0xD8, "hebrew"), (0xD8, 0xDC, "arabic"), (0xE0, 0xE1, "indic"), (0xE3, 0xE4, "kana"),
                   (0xE4, 0xEA, "han"), (0xEB, 0xEE, "hangul")):
    _SCRIPT[_a:_b] = SCRIPTS.index(_s)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_piece", "chars_per_byte_token", "byte_share", "piece_entropy")


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set flags between the offsets."""
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][off])


def repeated_words(w: Words, wh: np.ndarray) -> np.ndarray:
    """Per text, the words inside windows that the text holds twice or more."""
    n = len(w.counts)
    mark = np.zeros(len(wh), bool)
    if len(wh) >= WINDOW:
        doc = w.doc()
        m = len(wh) - WINDOW + 1
        h = mix(doc[:m].astype(np.uint64) * _ODD[WINDOW])
        for j in range(WINDOW):
            h = h * _ODD[j] + wh[j:j + m]
        real = np.flatnonzero(doc[:m] == doc[WINDOW - 1:])
        _, inv, count = np.unique(mix(h[real]), return_inverse=True, return_counts=True)
        twice = real[count[inv] > 1]
        for j in range(WINDOW):
            mark[twice + j] = True
    return _per_text(mark, w.first) if n else np.zeros(0, np.int64)


def repeated_lines(column: pa.Array, w: Words) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line."""
    lines = words(column, LINES)
    full = np.flatnonzero(np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start))
    h = lines.hashes()[full] if len(full) else np.zeros(0, np.uint64)
    doc = lines.doc()[full]
    _, first = np.unique(mix(h + mix(doc.astype(np.uint64) * _ODD[WINDOW])), return_index=True)
    again = np.ones(len(full), bool)
    again[first] = False
    return np.bincount(doc[again], minlength=len(lines.counts))


def counted(column: pa.Array) -> tuple[Words, np.ndarray, list[np.ndarray], np.ndarray]:
    """Words and their hashes, the plain counts of each text, and its main script."""
    w = words(column, EXACT)
    wh = w.hashes() if len(w.start) else np.zeros(0, np.uint64)
    raw, off = raw_bytes(column)
    plain = [w.counts, _per_text(_LEAD[raw] & SPACED.inside[raw], off), _per_text(_SYMBOL[raw], off),
             repeated_lines(column, w), repeated_words(w, wh)]
    script, text = _SCRIPT[raw], np.repeat(np.arange(len(column)), np.diff(off))
    per = np.bincount(text * len(SCRIPTS) + script, minlength=len(column) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
    per[:, 0] = 0  # digits, spaces and signs count for no script
    return w, wh, plain, per.argmax(1)


class Vocabularies:
    """The two public tokenisers, read on the driver and built again in each task."""

    def __init__(self, pieces: bytes, byte_level: str):
        self.pieces, self.byte_level = pieces, byte_level

    @classmethod
    def read(cls, pieces: str, byte_level: str) -> Vocabularies:
        with open(pieces, "rb") as f, open(byte_level, encoding="utf-8") as g:
            return cls(f.read(), g.read())


class Fertility:
    """Measures of texts; remembers the pieces of the words it has met."""

    def __init__(self, vocabularies: Vocabularies):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread's work, and each thread holds memory of its own
        import sentencepiece
        import tokenizers

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.pieces)
        self.byte_level = tokenizers.Tokenizer.from_str(vocabularies.byte_level)
        self.byte_level.no_truncation()
        self.byte_level.no_padding()
        self.byte_level.encode_special_tokens = True
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.known = KnownPieces()

    def _learn(self, new: np.ndarray, w: Words, at: np.ndarray) -> None:
        """A word's entry: the number of its byte-level tokens, then its pieces."""
        ids, size = [], []
        for lo in range(0, len(at), CALL):
            texts = [w.data[w.start[i]:w.end[i]].tobytes().decode("utf-8", "replace") for i in at[lo:lo + CALL]]
            pieces = self.pieces.encode(texts, num_threads=1)
            tokens = self.byte_level.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
            size.append(np.fromiter((1 + len(p) for p in pieces), np.int64, len(pieces)))
            ids.append(np.fromiter((i for t, p in zip(tokens, pieces) for i in (len(t), *p)), np.uint32, int(size[-1].sum())))
        self.known.append(new, np.concatenate(ids), np.concatenate(size))

    def measure(self, w: Words, wh: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pieces of each text, and its measures (not a number without pieces)."""
        n = len(w.counts)
        distinct, at, inv = np.unique(wh, return_index=True, return_inverse=True)
        if len(distinct):
            new = np.flatnonzero(~self.known.find(distinct)[1])
            if len(self.known.hash) + len(new) > CACHE:
                self.known, new = KnownPieces(), np.arange(len(distinct))
            if len(new):
                self._learn(distinct[new], w, at[new])
        place = self.known.find(distinct)[0][inv] if len(distinct) else np.zeros(0, np.int64)
        start, size = (self.known.at[place], self.known.size[place]) if len(place) else (place, place)
        tokens = np.bincount(w.doc(), self.known.ids[start] if len(start) else None, minlength=n)
        ids = self.known.ids[take_spans(start + 1, size - 1)].astype(np.int64)
        doc = np.repeat(w.doc(), size - 1)
        total = np.bincount(doc, minlength=n)
        key, count = np.unique(doc * len(self.fallback) + ids, return_counts=True)
        spread = np.bincount(key // len(self.fallback), count * np.log2(count), minlength=n)
        with np.errstate(divide="ignore", invalid="ignore"):
            entropy = np.where(total > 1, (np.log2(total) - spread / total) / np.log2(total), 1.0)
            share = np.bincount(doc, self.fallback[ids], minlength=n) / total
            out = [chars / total, chars / tokens, share, np.where(total > 0, entropy, np.nan)]
        return total, [np.where(total > 0, x, np.nan) for x in out]


@lru_cache(1)
def shared_fertility(pieces: bytes, byte_level: str) -> Fertility:
    """A worker's libraries, kept with the words they have met from one task to the next."""
    return Fertility(Vocabularies(pieces, byte_level))


def measures(spark: SparkSession, docs: DataFrame, vocabularies: Vocabularies, text: str = "text", language: str | None = "lang",
             keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``band`` (language or ``script:``), ``n_pieces``, ``COUNTS``, ``MEASURES``.

    Narrow: each task measures its own partition, a megabyte of text at a time.
    """
    arrow_batches(spark, size=4 << 20)
    tables = spark.sparkContext.broadcast(vocabularies)  # two vocabularies of fixed size
    group = F.col(f"`{language}`") if language in docs.columns else F.lit(None)
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), group.cast("string").alias("band"),
                         F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([source.schema["row"], T.StructField("band", T.StringType()),
                           *[T.StructField(c, T.LongType()) for c in ("n_pieces", *COUNTS)],
                           *[T.StructField(c, T.DoubleType()) for c in MEASURES]])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sweepframe.llm.fertility import shared_fertility  # the worker's own module, not this task's copy

        fertility = shared_fertility(tables.value.pieces, tables.value.byte_level)
        for batch in batches:
            for lo, hi in chunks(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                w, wh, plain, script = counted(part.column(2))
                total, found = fertility.measure(w, wh, plain[1])
                band = [x if x is not None else f"script:{SCRIPTS[s]}" for x, s in zip(part.column(1).to_pylist(), script)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(band, pa.string()), *[pa.array(x, pa.int64()) for x in (total, *plain)],
                     *[pa.array(x, pa.float64(), mask=np.isnan(x)) for x in found]], names=schema.names)

    return source.mapInArrow(task, schema)


def bands(measured: DataFrame) -> DataFrame:
    """``band, doublings, support`` and ``low_x, high_x`` for each measure, from all distinct sets of measures.

    Measures become whole numbers of ``1 / BINS``; their counts per group are
    few (a measure's range times ``BINS``), and so is what the windows see.
    """
    whole = [F.floor(F.col(c) * BINS).alias(c) for c in MEASURES]
    exact = [F.col(c).alias("x_" + c) for c in MEASURES]
    # copies are combined before the shuffle and count once
    once = measured.where("n_pieces > 0").select("band", F.floor(F.log2("n_pieces")).cast("int").alias("doublings"), "n_pieces", *exact, *whole)
    once = once.dropDuplicates(["band", "n_pieces", *["x_" + c for c in MEASURES]])
    long = once.select("band", "doublings", F.explode(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).alias("bin")) for c in MEASURES])).alias("m")).select("band", "doublings", "m.*")
    key = ["band", "doublings", "measure"]
    counts = long.groupBy(*key, "bin").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy(*key).orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(W.partitionBy(*key)))

    def at(share: float):
        """The first bin up to which this share of the group lies."""
        return F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bin"))) / BINS

    groups = counts.groupBy(*key).agg(F.first("total").alias("support"), at(0.25).alias("q1"), at(0.5).alias("mid"), at(0.75).alias("q3"))
    floor = (F.when(F.col("measure") == "byte_share", F.lit(FALLBACK_FLOOR))
             .when(F.col("measure") == "piece_entropy", ENTROPY_FLOOR * F.col("mid")).otherwise(FLOOR * F.col("mid")))
    side = SPREAD * F.greatest((F.col("q3") - F.col("q1")) / _QUARTILES, floor)
    groups = groups.select(*key, "support", (F.col("mid") - side).alias("low"), (F.col("mid") + side).alias("high"))
    one = [F.max(F.when(F.col("measure") == c, F.col(x))).alias(f"{x}_{c}") for c in MEASURES for x in ("low", "high")]
    return groups.groupBy("band", "doublings").agg(F.max("support").alias("support"), *one)


def judged(spark: SparkSession, measured: DataFrame) -> DataFrame:
    """The rows' own columns and what ``measures`` gave, with ``base_failed, kept`` and ``outside`` (the measures outside their bands).

    The measures are written once, so texts are encoded once; the bands are
    counted and broadcast only within the library's bound.
    """
    measured = written(spark, measured, "fertility_measures")
    limits = written(spark, bands(measured), "fertility_bands")
    rows = measured.withColumn("doublings", F.floor(F.log2(F.when(F.col("n_pieces") > 0, F.col("n_pieces")))).cast("int"))
    rows = rows.join(maybe_broadcast(limits, limits.count()), ["band", "doublings"], "left")
    known = F.coalesce(F.col("support") >= SUPPORT, F.lit(False))
    outside = F.filter(F.array(*[
        F.when(known & ((F.col(c) < F.col("low_" + c)) | (F.col(c) > F.col("high_" + c))), F.lit(c)) for c in MEASURES]), lambda m: m.isNotNull())
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    kept = ~failed & (F.size(outside) == 0) & (F.col("n_pieces") > 0)
    keep = [f.name for f in measured.schema["row"].dataType.fields]
    rows = rows.select("row", *measured.columns[1:], failed.alias("base_failed"), outside.alias("outside"), kept.alias("kept"))
    names = rows.columns[1:]
    out = rows.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.struct(*names).alias("_"))
    return out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_.{c}").alias(fresh(out.drop("_"), c)) for c in names])
