"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

#: Columns whose names clash with what operators use inside or add.
EXTRA = ["rid", "digest", "score", "ids", "times", "node", "size", "n_words"]


def docs(spark, rows, extra=False):
    """``rows`` of ``(doc_id, text[, source])``; with ``extra``, clashing columns too."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None) for r in rows]
    schema = DOCS
    if extra:
        schema = T.StructType([*DOCS.fields, *[T.StructField(c, T.StringType()) for c in EXTRA]])
        full = [(*r, *[f"{c}{i}" for c in EXTRA]) for i, r in enumerate(full)]
    return spark.createDataFrame(full, schema)


def stored(spark, df, tmp):
    path = f"{tmp}/docs.parquet"
    df.write.parquet(path)
    return spark.read.parquet(path)


def sentence(rnd, n, words=400):
    return " ".join(f"w{rnd.randrange(words)}" for _ in range(n))


def awkward(seed=0):
    """Null and empty texts, white space only, one word, a very long text, copies and near copies."""
    rnd = random.Random(seed)
    base = sentence(rnd, 120).split()
    near = []
    for k in range(12):
        w = list(base)
        for _ in range(k % 4):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10 ** 6)}"
        near.append(" ".join(w))
    texts = [None, "", " \t\n", "one", "One two", "one  two", "ÀÉ ß ς Σ", sentence(rnd, 20_000), sentence(rnd, 50), *near]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(100 + i, t) for i, (_, t) in enumerate(rows[:10])]
