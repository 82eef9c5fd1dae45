"""Tolerant parse (S5), ids (T9), header build (S8), JSON encode."""

from pyspark.sql import functions as F

from sweepframe.functions.records import header_record, parse_records, to_record_json


def parse(spark, texts):
    df = spark.createDataFrame([(i, t.encode("utf-8")) for i, t in enumerate(texts)], "block_idx long, payload binary")
    return parse_records(df.withColumn("path", F.lit("p"))).orderBy("block_idx").collect()


def test_control_chars_and_escapes(spark):
    rows = parse(spark, ['{"task_id": 1, "output_dat": "a\tb\nc\r\n"}', '{"task_id": 2, "output_dat": "x\\ny"}'])
    assert rows[0].output_dat == "a\tb\nc\r\n"
    assert rows[1].output_dat == "x\ny"


def test_junk_truncated_and_empty(spark):
    rows = parse(spark, ['junk {"task_id": 3}', '{"task_id": 4, "output_dat": "abc', "", "€"])
    assert [r.task_id for r in rows] == [3]


def test_fractional_and_missing_ids(spark):
    rows = parse(spark, ['{"task_id": 7.9, "seed": 2}', '{"seed": 1, "cfg_id": null}'])
    assert rows[0].task_id == 7 and rows[0].params_id is None
    assert rows[1].task_id is None and rows[1].cfg_id is None


def test_multibyte_text(spark):
    rows = parse(spark, ['{"task_id": 1, "cfg_id": "é中"}'])
    assert rows[0].cfg_id == "é中"


def test_header_record_parity(spark):
    df = spark.range(1).select(header_record(F.create_map(F.lit("USER"), F.lit("u")),
                                             F.lit("header=true,a=1,b=x=y,a=2")).alias("m"),
                               header_record(F.create_map(F.lit("USER"), F.lit("u")),
                                             F.lit("b=x=y"), strict=False).alias("full"))
    r = df.collect()[0]
    assert r.m == {"USER": "u", "header": "true", "a": "2", "b": "x"}
    assert r.full["b"] == "x=y"


def test_to_record_json_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None)], "task_id long, cfg_id string")
    s = df.select(to_record_json(df).alias("j")).collect()[0].j
    assert s == '{"task_id":1,"cfg_id":null}'
