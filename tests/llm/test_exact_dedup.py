import hashlib
import re

from helpers import awkward, docs, stored

from sweepframe.llm.exact_dedup import DigestIndex, dedup_report, deduplicate


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return sorted((i, min(groups[norm(t)]), len(groups[norm(t)]), i == min(groups[norm(t)]),
                   hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)


def test_report_against_brute_force(spark):
    rows = awkward() + [(200, "a\x0bb"), (201, "a b"), (202, "a\xa0b")]
    assert sorted(tuple(r) for r in dedup_report(spark, docs(spark, rows)).collect()) == brute(rows)


def test_hot_group_and_repeated_rows(spark):
    rows = [(i, "same text") for i in range(3000)] + [(0, "same text"), (None, "same text"), (5000, "other")]
    got = dedup_report(spark, docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got if r.kept] == [0, 5000] or sorted(r.doc_id for r in got if r.kept) == [0, 5000]
    assert {r.group_size for r in got if r.keep_id == 0} == {3002}


def test_index_persists_over_batches(spark, tmp):
    index = DigestIndex(spark, f"{tmp}/index", buckets=4)
    first = dedup_report(spark, docs(spark, [(1, "a"), (2, "b")]), index).collect()
    assert all(r.kept for r in first)
    again = DigestIndex(spark, f"{tmp}/index", buckets=4)
    second = {r.doc_id: r for r in dedup_report(spark, docs(spark, [(3, "a"), (0, "c"), (4, "c")]), again).collect()}
    assert (second[3].kept, second[3].keep_id, second[3].group_size) == (False, 1, 2)
    assert second[0].kept and not second[4].kept
    assert again.read().count() == 3


def test_index_is_read_without_a_shuffle(spark):
    index = DigestIndex(spark, buckets=8)
    dedup_report(spark, docs(spark, awkward()), index).collect()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = index.read().hint("merge").join(index.read(), "digest", "left_anti")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange hashpartitioning" not in plan.split("== Physical Plan ==")[1]


def test_stage_keeps_columns(spark, tmp):
    d = stored(spark, docs(spark, awkward(), extra=True), tmp)
    out = deduplicate(spark, d)
    assert out.columns == d.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, k, _, kept, _ in brute(awkward()) if kept)


def test_empty(spark):
    assert dedup_report(spark, docs(spark, [])).count() == 0
    assert deduplicate(spark, docs(spark, [])).count() == 0
