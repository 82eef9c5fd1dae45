"""The pipeline on a small corpus, stage by stage against brute force; the queries on the smallest tables."""

import re

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from sweepframe.llm import queries as Q
from test_ngram_join import brute as near_groups

SF = "/root/testdata/sf0.001"
#: The stages need some hundred labelled rows.
CORPUS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    from sweepframe.llm.common import written

    docs, out = spark.read.parquet(f"{CORPUS}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in C.STAGES:
        docs = written(spark, stage(spark, docs, CORPUS), "test_stage")
        out[name] = docs
        assert name == "bpe" or docs.columns == columns
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "mixing", "bpe"]


def test_quality(spark, stages):
    bad = {r.doc_id for r in spark.read.parquet(f"{CORPUS}/labels.parquet").where("quality = 0").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{CORPUS}/labels.parquet").where("quality = 1").collect()}
    kept = set(texts(stages["quality_classifier"]))
    assert len(bad & kept) <= 0.2 * len(bad) + 1 and len(good - kept) <= 0.1 * len(good)


def test_exact(stages):
    first = {}
    for i, t in sorted(texts(stages["quality_classifier"]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    assert set(texts(stages["exact_dedup"])) == set(first.values())


def test_near(stages):
    rows = sorted(texts(stages["exact_dedup"]).items())
    assert set(texts(stages["ngram_jaccard_join"])) == {i for i, n, c in near_groups(rows, 5, 80) if i == c or n == 0}


def test_mix_and_ids(stages):
    before, mixed = stages["ngram_jaccard_join"].collect(), stages["mixing"].collect()
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows)
    assert abs(words(mixed) - words(before)) < 0.1 * words(before)
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in before}
    out = stages["bpe"].collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed)
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_run_equals_stages(spark, stages):
    assert sorted(r.doc_id for r in E.queries()["pipeline"](spark, CORPUS).collect()) == sorted(r.doc_id for r in stages["bpe"].collect())


#: Their rows are not those of a table: see test_negatives and test_conversation_trie.
OTHER_ROWS = {"op11_hard_negatives", "op13_conversation_trie"}


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - OTHER_ROWS))
def test_queries_run_over_whole_tables(spark, name):
    table = {"op2_topk": "embeddings", "op9_url_filter": "pages"}.get(name, "documents")
    n = Q.queries()[name](spark, SF).count()
    rows = spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert n == (10 * -(-rows // 100) if name == "op2_topk" else rows)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_queries_equal_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = Q.queries()[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({Q.oracle_sql()[name]})").fetchall()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)
