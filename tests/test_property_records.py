"""Tolerant record parse (S5): blocks are built around known records, which the parse must give back."""

import json
import random

from pyspark.sql import functions as F

from sweepframe.functions.records import parse_records

TEXT = ["a", "b", " ", "\n", "\t", "\r", "\"", "\\", "/", "{", "}", "é"]


def block(rnd, task_id, dat):
    """The record as text: any indent, control characters raw or escaped, junk before, anything behind."""
    body = json.dumps({"task_id": task_id, "output_dat": dat}, indent=rnd.choice([None, 2]), ensure_ascii=False)
    if "\\" not in dat and rnd.random() < 0.5:  # as a writer that pastes text into the record leaves it
        body = body.replace("\\n", "\n").replace("\\t", "\t").replace("\\r", "\r")
    return rnd.choice(["", " ", "\n"]) + body + rnd.choice(["", "\n", " {\"task_id\": 1}", " trailing"])


def parsed(spark, texts):
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "block_idx long, payload binary")
    return {r.block_idx: (r.task_id, r.output_dat) for r in parse_records(df.withColumn("path", F.lit("p"))).collect()}


def test_known_records_come_back(spark):
    rnd = random.Random(11)
    known = [(i * 7, "".join(rnd.choice(TEXT) for _ in range(rnd.randrange(14)))) for i in range(120)]
    assert parsed(spark, [block(rnd, *k) for k in known]) == dict(enumerate(known))


def test_cut_blocks_give_nothing(spark):
    rnd = random.Random(12)
    whole = [json.dumps({"task_id": i, "output_dat": "x\ny {"}) for i in range(40)]
    assert parsed(spark, [w[:rnd.randrange(len(w))] for w in whole]) == {}
