"""Registered queries of the operators and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sweepframe.llm import bpe, conversation_trie, exact_dedup, fertility, licenses, mixing, negatives, ngram_join, quality, repair, topk, toxicity, url_filter
from sweepframe.llm.common import table
from sweepframe.llm.labelled import held_out
from sweepframe.session import prepare


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: 3-word shingles, similarity 0.9."""
    return ngram_join.report(spark, table(spark, sf_dir, "documents"), 3, 90)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose id is divisible by 100 against all rows."""
    return topk.top_k(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id,
                  CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against the licence templates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(spark, docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by trees fitted on the training rows of ``labels.quality``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(spark, docs, table(spark, sf_dir, "labels"))
    scored = quality.score(spark, docs, model)
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                         "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents graded by the ordinal model fitted on the training rows of ``labels.toxic``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(spark, docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(spark, docs, model)
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"),
                         "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "grade", "expected_severity")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(spark, docs, vocabulary("word_bpe_49k.json")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against a fresh digest index."""
    return exact_dedup.dedup_report(spark, table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
     g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as Re-Pair shards and read back."""
    return repair.roundtrip_digests(spark, table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


#: The rules of op9: verdict and host/path.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url."""
    return url_filter.judge(spark, table(spark, sf_dir, "pages"), URL_RULES)


def _op9_sql() -> str:
    """The rules, then the template tree level by level."""
    u = url_filter
    rest = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END"
    az, low = string.ascii_uppercase, string.ascii_lowercase
    ordered = sorted(URL_RULES, key=lambda r: (-len(r[1]), r[1]))
    cut = {r: r.index("/") for _, r in ordered}
    rule = "CASE " + " ".join(
        f"WHEN (host = '{r[:cut[r]]}' OR ends_with(host, '.{r[:cut[r]]}')) AND starts_with(path, '{r[cut[r]:]}') THEN '{r}'"
        for _, r in ordered) + " END"
    said = "CASE " + " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in ordered) + " END"
    return f"""
WITH RECURSIVE p0 AS (SELECT page_id, {rest} AS rest FROM pages),
p1 AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{az}', '{low}'), '') AS host,
              coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p0),
p2 AS (SELECT *, {rule} AS rule,
              list_filter(string_split(replace(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '*', '%2A'), '/'),
                          lambda s: s <> '') AS shape FROM p1),
p3 AS (SELECT *, {said} AS said FROM p2),
v AS (SELECT host, shape, count(*) AS n, sum(CASE WHEN said = 'block' THEN 1 ELSE 0 END) AS b FROM p3 GROUP BY ALL),
h AS (SELECT host, sum(n) AS pn, sum(b) AS pb FROM v GROUP BY host),
lev AS (
  SELECT 0 AS i, v.host, shape, CAST(n AS DOUBLE) AS n, CAST(b AS DOUBLE) AS b, v.host AS node,
         CAST(pn AS DOUBLE) AS pn, CAST(pb AS DOUBLE) AS pb,
         (pb + {u.PRIOR_WEIGHT} * CAST({u.PRIOR} AS DOUBLE)) / (pn + {u.PRIOR_WEIGHT}) AS purity FROM v JOIN h USING (host)
  UNION ALL
  (WITH s AS (SELECT *, shape[i + 1] AS seg FROM lev WHERE len(shape) > i AND pn >= {u.MIN_SUPPORT}),
   c AS (SELECT node, seg, any_value(pn) AS pn, any_value(pb) AS pb, sum(n) AS bn, sum(b) AS bb FROM s GROUP BY node, seg),
   c1 AS (SELECT *, CASE WHEN bn >= {u.MIN_SUPPORT} THEN floor({u.BANDS} * bb / bn) END AS band FROM c),
   d AS (SELECT node, band, any_value(pn) AS pn, any_value(pb) AS pb, sum(bn) AS cn, sum(bb) AS cb, count(*) AS k, min(seg) AS one
         FROM c1 WHERE band IS NOT NULL GROUP BY node, band),
   d1 AS (SELECT *, lag(cn) OVER w AS ln, lag(cb) OVER w AS lb FROM d WINDOW w AS (PARTITION BY node ORDER BY band)),
   d2 AS (SELECT *, CASE WHEN ln IS NULL OR abs(lb / ln - cb / cn) > {u.Z} * sqrt(((lb + cb) / (ln + cn))
                    * (1 - (lb + cb) / (ln + cn)) * (1 / ln + 1 / cn)) THEN 1 ELSE 0 END AS edge FROM d1),
   d3 AS (SELECT *, sum(edge) OVER (PARTITION BY node ORDER BY band) AS class FROM d2),
   d4 AS (SELECT node, class, any_value(pn) AS pn, any_value(pb) AS pb, sum(cn) AS cn, sum(cb) AS cb, sum(k) AS k, min(one) AS one
          FROM d3 GROUP BY node, class),
   d5 AS (SELECT node, class, CASE WHEN abs(cb / cn - pb / pn) > {u.Z} * sqrt((pb / pn) * (1 - pb / pn) / cn)
                 THEN CASE WHEN k = 1 THEN one ELSE '*' || CAST(class AS BIGINT) END END AS name FROM d4),
   e AS (SELECT c1.node, c1.seg, c1.bn, c1.bb, coalesce(d5.name, '*') AS name
         FROM c1 LEFT JOIN d3 ON c1.node = d3.node AND c1.band = d3.band LEFT JOIN d5 ON d3.node = d5.node AND d3.class = d5.class),
   g AS (SELECT *, sum(bn) OVER w AS gn, sum(bb) OVER w AS gb FROM e WINDOW w AS (PARTITION BY node, name))
   SELECT s.i + 1, s.host, s.shape, s.n, s.b, s.node || '/' || g.name, g.gn, g.gb,
          (g.gb + {u.PRIOR_WEIGHT} * s.purity) / (g.gn + {u.PRIOR_WEIGHT})
   FROM s JOIN g ON s.node = g.node AND s.seg = g.seg)),
l AS (SELECT host, shape, CASE WHEN len(shape) > i THEN node || '/**' ELSE node END AS template, purity
      FROM lev WHERE NOT (len(shape) > i AND pn >= {u.MIN_SUPPORT}))
SELECT page_id, p3.host, path, rule,
       coalesce(said, CASE WHEN purity > {u.REJECT} THEN 'block' ELSE 'allow' END) AS verdict, template
FROM p3 JOIN l ON p3.host = l.host AND p3.shape = l.shape
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix over all documents."""
    return mixing.mix_report(spark, table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose id is divisible by 100 as anchors, against all rows."""
    i = F.col("vec_id")
    label = F.when(i % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark, table(spark, sf_dir, "embeddings"), i % 100 == 0, label=label)


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id,
                  CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
     p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
           QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by plain counts and by how two public vocabularies cut them."""
    tables = fertility.Vocabularies.read(vocabulary("piece_bpe_32k.model"), vocabulary("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    judged = fertility.judged(spark, fertility.measures(spark, docs, tables))
    return judged.select("doc_id", *fertility.COUNTS, "base_failed", "kept", "n_pieces", *fertility.MEASURES,
                         F.array_join("outside", ",").alias("outside"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, each with the head of its hundred's first one."""
    i = F.col("conv_id")
    return conversation_trie.trie(spark, table(spark, sf_dir, "conversations"), base=i - i % 100,
                                  head=F.crc32(i.cast("string").cast("binary")) % 6)


_QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_topk": op2_topk,
    "op3_license_scan": op3_license_scan,
    "op4_quality": op4_quality,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op8_token_output": op8_token_output,
    "op9_url_filter": op9_url_filter,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_conversation_trie": op13_conversation_trie,
    "op7_exact_dedup": op7_exact_dedup,
}

_SQL = {
    "op2_topk": OP2_SQL,
    "op9_url_filter": _op9_sql(),
    "op11_hard_negatives": OP11_SQL,
    "op7_exact_dedup": OP7_SQL,
}


def _prepared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _prepared(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
