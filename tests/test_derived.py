"""Inputs that the queries derive from the tables, on small tables of their own."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from sweepframe.functions.daytable import explode_days
from sweepframe.functions.records import parse_records, split_header, to_record_json
from sweepframe.plans import derived as D
from sweepframe.plans import fixtures as fx
from sweepframe.plans import queries as Q
from sweepframe.sources import text
from sweepframe.sources.blocklog import file_blocks, list_log_files, scan_blocks, whole_blocks


def orders_and_lines(spark, folder, days, priority="1-URGENT"):
    """Order i has ``days[i]`` lines."""
    t = datetime.datetime(1996, 1, 2, 3, 4, 5, 678901)
    spark.createDataFrame([(i, 7 * i, priority, t, 1234567.891234 * (i - 1)) for i in range(len(days))],
                          "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp_ntz, o_totalprice double"
                          ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, 100 + j, j % 3, j % 7, 12345.678 * j, 50.25, 0.1234567, 0.08, "RAN"[j % 3], t) for i, n in enumerate(days) for j in range(n)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_quantity double, "
                          "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_blocks_are_as_long_as_the_longest_record(spark, tmp):
    """A log's size is its records times the block: blocks of 4 KiB made it 14 times its text."""
    sf = orders_and_lines(spark, tmp, [1, 4, 7, 2, 0, 5])
    rec = fx.d1_records(spark, sf)
    longest = rec.select(F.max(F.octet_length(to_record_json(rec)))).first()[0]
    log = D.d1_log(spark, sf)
    assert longest <= D.block_size(spark, sf) <= 1.2 * longest
    assert D.blocks(spark, log).where("block_idx > 0").count() == 5
    assert sum(n for _, n in list_log_files(log)) <= 1.2 * longest * (5 + len(list_log_files(log)))


def test_blocks_hold_long_records(spark, tmp):
    a = orders_and_lines(spark, os.path.join(tmp, "a"), [1, 300], "\x01\"\\é\n" * 40)
    b = orders_and_lines(spark, os.path.join(tmp, "b"), [3, 1], None)
    for sf, days in ((a, 301), (b, 4)):
        for log in (D.d1_log(spark, sf), D.d1_short_log(spark, sf)):
            _, recs = split_header(parse_records(D.blocks(spark, log)))
            assert recs.count() == 2 and recs.agg(F.sum(F.size(F.split("output_dat", "\n")) - 2)).first()[0] == days
            assert explode_days(recs).count() <= days


def test_a_log_takes_less_disk_than_its_records(spark, tmp):
    """Plain blocks: a log took as much disk as the text of its records, some five times its tables."""
    sf = orders_and_lines(spark, tmp, [1 + i % 7 for i in range(2000)])
    rec = fx.d1_records(spark, sf)
    text_bytes = rec.select(F.sum(F.octet_length(to_record_json(rec)))).first()[0]
    for log in (D.d1_log(spark, sf), D.d1_short_log(spark, sf)):
        assert sum(os.path.getsize(p) for p, _ in list_log_files(log)) < text_bytes / 2
    assert tuple(Q.q_conversion_counts(spark, sf).first()) == (2000, rec.select(F.sum("day_final")).first()[0], 2000)
    assert {r.content_blocks for r in Q.q_log_stat(spark, sf).collect()} == {2000}


def test_one_long_record_does_not_lengthen_the_others(spark, tmp, monkeypatch):
    """Blocks as long as the longest record: 99 short ones took 300 lines' room each."""
    monkeypatch.setattr(fx, "SHARE_ORDERS", 40)  # three appends
    days = [300] + [1 + i % 7 for i in range(99)]
    sf = orders_and_lines(spark, tmp, days)
    rec = fx.d1_records(spark, sf)
    sizes = [r[0] for r in rec.select(F.octet_length(to_record_json(rec))).collect()]
    log = D.d1_log(spark, sf)
    files = file_blocks(log, "listed")
    assert len({b for _, _, b in files}) > 2
    assert sum(n for _, n, _ in files) <= 1.15 * sum(sizes) + sum(b for _, _, b in files)
    assert whole_blocks(log, "listed") == whole_blocks(log, "auto") == 100 + len(files)
    for blocks in (D.blocks(spark, log), scan_blocks(spark, log, "listed")):
        _, recs = split_header(parse_records(blocks))
        assert sorted((r.task_id, r.day_final) for r in recs.select("task_id", "day_final").collect()) == list(enumerate(days))
    assert sorted((r.task_id, r.day_final) for r in Q.q_blocklog_extract(spark, sf).collect()) == list(enumerate(days))
    assert tuple(Q.q_conversion_counts(spark, sf).first()) == (100, sum(days), 100)
    assert {r.content_blocks for r in Q.q_log_stat(spark, sf).collect()} == {100}
    tail = Q.q_blocklog_tail(spark, sf).collect()
    assert sum(r.n_ok for r in tail) == 100 and {r.batches for r in tail} == {6}  # 50 by 17, twice
    short = parse_records(D.blocks(spark, D.d1_short_log(spark, sf)))
    assert sorted(r.task_id for r in short.collect()) == list(range(100))


def events(spark, folder, rows):
    t = datetime.datetime(2024, 1, 1)
    rows = [(i, t + datetime.timedelta(seconds=i), u, kind, v) for i, (u, kind, v) in enumerate(rows)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(f"{folder}/events.parquet")
    return folder


def test_many_runs_need_few_stdout_files(spark, tmp):
    """A folder and a file for every run: the listing grew with the runs, 3,000 here."""
    sf = events(spark, tmp, [(i % 3000, ("click", "signup", "purchase")[i // 3000], i + 0.5) for i in range(9000)])
    files = [f for _, _, fs in os.walk(D.stdout_files(spark, sf)) for f in fs if f.endswith(".txt")]
    assert len(files) <= 64
    got = {r.task_id: (r.setup, r.sim, r.early) for r in Q.q_stdout_timings(spark, sf).collect()}
    assert got == {u: (u + 3000.5, u + 6000.5, False) for u in range(3000)}
    assert {(r.task_id, r.day, r.infected) for r in Q.q_day_scrape(spark, sf).collect()} == {(u, u, u) for u in range(3000)}


def test_odd_stdout_lines_stay_with_their_run(spark, tmp):
    sf = events(spark, tmp, [(5, "click", 1.0), (None, "click", 2.0), (-3, "signup", 3.0), (5, "a\r\nb\tc\rTIME: SIM: 7 \n", 4.0),
                             (None, "purchase", 5.0), (-3, None, 6.0), (-3, "click", None), (-3, "error", 301.0)])
    lines = [(r.task_id, r.line) for r in Q._stdout(spark, sf).orderBy("task_id", "line_key").collect()]
    assert lines == [(None, ""), (None, "TIME: SIM: 5.0"), (-3, "TIME: SETUP: 3.0"), (-3, ""), (-3, ""),
                     (-3, "EARLY-EXIT at 301.0"), (5, "[Day 0 of run 5: 1; deaths 5"), (5, "a"), (5, "b\tc"), (5, "TIME: SIM: 7 "), (5, " 4.0")]
    assert {r.task_id: (r.setup, r.sim, r.early) for r in Q.q_stdout_timings(spark, sf).collect()} == {
        None: (None, 5.0, False), -3: (3.0, None, True), 5: (None, 7.0, False)}
    with open(f"{tmp}/untagged.txt", "w") as f:
        f.write("no tag\n")
    with pytest.raises(Exception, match="without a tag"):
        text.read_tagged_stdout(spark, f"{tmp}/untagged.txt").collect()
