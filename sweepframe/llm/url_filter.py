"""URL filter: explicit rules first, then a per-host tree of path templates (DataFrame operations only).

Pages are first reduced to distinct (host, path shape) rows: digit runs in a
path segment become ``{n}``.  Level by level, each node's next segments
become its branches.  Branches of fewer than ``MIN_SUPPORT`` pages are
variable segments and merge into the wildcard ``*``.  The others are
compared with each other: they are grouped by their share of blocked pages
(``BANDS`` bands), neighbouring bands whose shares differ by at most ``Z``
standard errors merge, and so on into classes of similar branches.  A class
that differs from its parent by more than ``Z`` standard errors becomes a
node, named after its segment, or ``*1``, ``*2``, ... where it has several;
classes that do not differ join the wildcard.  A node of fewer than
``MIN_SUPPORT`` pages has no branches: what lies below is ``**``.  There is
no other limit on depth.

The labels are the rules' verdicts: a template's purity is its share of
pages known to be blocked, smoothed towards its parent's (the host's towards
``PRIOR``), and a template of purity above ``REJECT`` is blocked for pages
without a rule.

Defined results: a null url or one without ``://`` has an empty host and
path, and belongs to the empty host's root; rows that repeat a page id are
judged one by one; no rows give no rows; a ``*`` of a path reads ``%2A``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sweepframe.llm.common import hot_join, written
from sweepframe.session import scratch_path

BANDS = 16
MIN_SUPPORT = 8
Z = 2.0
PRIOR = 0.2
PRIOR_WEIGHT = 4
REJECT = 0.6


def _between(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_between(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_between(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ``(verdict, 'host/path')`` that fits the host or a parent domain of it; else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        cut = rule.index("/")
        fits = (host == rule[:cut]) | F.endswith(host, F.lit("." + rule[:cut]))
        out = F.when(fits & F.startswith(path, F.lit(rule[cut:])), F.lit(rule)).otherwise(out)
    return out


def verdict_of_rule(rule: Column, rules: list[tuple[str, str]]) -> Column:
    out = F.lit(None).cast("string")
    for verdict, name in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def _shape(path: Column) -> Column:
    """The path's segments with digit runs generalised."""
    parts = F.split(F.regexp_replace(F.regexp_replace(path, "[0-9]+", "{n}"), r"\*", "%2A"), "/", -1)
    return F.filter(parts, lambda s: s != "")


def _differ(n1: Column, b1: Column, n2: Column, b2: Column) -> Column:
    """Two groups' shares of blocked pages differ by more than ``Z`` standard errors of their pooled share."""
    share = (b1 + b2) / (n1 + n2)
    return F.abs(b1 / n1 - b2 / n2) > Z * F.sqrt(share * (1 - share) * (1 / n1 + 1 / n2))


def _branches(spark: SparkSession, level: DataFrame) -> DataFrame:
    """The next nodes of ``level (node, branch, seg, n, b, pn, pb)``: ``branch, name, gn, gb, rows``,
    ``gn`` and ``gb`` the pages and blocked pages of the node that the branch becomes part of."""
    child = (level.groupBy("branch").agg(F.first("node").alias("node"), F.first("seg").alias("seg"), F.first("pn").alias("pn"),
                                         F.first("pb").alias("pb"), F.sum("n").alias("bn"), F.sum("b").alias("bb"),
                                         F.count(F.lit(1)).alias("rows"))
             .withColumn("band", F.when(F.col("bn") >= MIN_SUPPORT, F.expr(f"{BANDS} * bb div bn"))))
    child = written(spark, child, "url_branches")
    band = (child.where("band IS NOT NULL").groupBy("node", "band")
            .agg(F.first("pn").alias("pn"), F.first("pb").alias("pb"), F.sum("bn").alias("cn"), F.sum("bb").alias("cb"),
                 F.count(F.lit(1)).alias("k"), F.min("seg").alias("one")))
    up = W.partitionBy("node").orderBy("band")  # at most BANDS + 1 rows
    edge = _differ(F.lag("cn").over(up), F.lag("cb").over(up), F.col("cn"), F.col("cb"))
    band = band.withColumn("edge", F.coalesce(edge, F.lit(True)).cast("int")).withColumn("class", F.sum("edge").over(up))
    group = W.partitionBy("node", "class")
    band = band.select("node", "band", "class", "pn", "pb", F.sum("k").over(group).alias("k"), F.min("one").over(group).alias("one"),
                       F.sum("cn").over(group).alias("cn"), F.sum("cb").over(group).alias("cb"))
    share = F.col("pb") / F.col("pn")
    own = F.abs(F.col("cb") / F.col("cn") - share) > Z * F.sqrt(share * (1 - share) / F.col("cn"))
    name = F.when(own, F.when(F.col("k") == 1, F.col("one")).otherwise(F.concat(F.lit("*"), F.col("class").cast("string"))))
    named = band.select("node", "band", name.alias("name"))
    child = child.join(named, ["node", "band"], "left").withColumn("name", F.coalesce("name", F.lit("*")))
    child = written(spark, child, "url_named")
    total = child.groupBy("node", "name").agg(F.sum("bn").alias("gn"), F.sum("bb").alias("gb"))
    return child.join(total, ["node", "name"]).select("branch", "name", "gn", "gb", "rows")


def template_tree(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``pages (key, host, shape, blocked)`` -> one row per distinct key: ``key, n, template, purity``.

    Works on distinct shapes with counts; totals come from partial aggregates
    and go back through ``hot_join``, so a hot host is spread by its shapes.
    Every level is written; rows whose template has ended move to the result.
    """
    shapes = (pages.groupBy("key").agg(F.first("host").alias("node"), F.first("shape").alias("shape"),
                                       F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b")))
    shapes = written(spark, shapes, "url_shapes")
    host = shapes.groupBy("node").agg(F.sum("n").alias("pn"), F.sum("b").alias("pb"), F.count(F.lit(1)).alias("rows"))
    host = host.withColumn("purity", (F.col("pb") + PRIOR_WEIGHT * F.lit(PRIOR)) / (F.col("pn") + PRIOR_WEIGHT))
    level = hot_join(shapes, written(spark, host, "url_hosts"), "node", "rows", shapes.count()).drop("rows")
    path, depth = scratch_path(spark, "url_templates"), 0
    while True:
        level = written(spark, level, f"url_level{depth}")
        left, inner = F.size("shape") > depth, F.col("pn") >= MIN_SUPPORT
        template = F.when(left, F.concat("node", F.lit("/**"))).otherwise(F.col("node"))
        ended = level.where(~(left & inner)).select("key", "n", template.alias("template"), "purity")
        ended.write.mode("append").parquet(path)
        level = level.where(left & inner).withColumn("seg", F.get("shape", F.lit(depth)))
        level = level.withColumn("branch", F.concat("node", F.lit("/"), "seg"))
        rows = level.count()
        if not rows:
            return spark.read.schema(ended.schema).parquet(path)
        smooth = (F.col("gb") + PRIOR_WEIGHT * F.col("purity")) / (F.col("gn") + PRIOR_WEIGHT)
        branches = written(spark, _branches(spark, level), "url_nodes")
        level = hot_join(level, branches, "branch", "rows", rows).select(
            "key", "shape", "n", "b", F.concat("node", F.lit("/"), "name").alias("node"),
            F.col("gn").alias("pn"), F.col("gb").alias("pb"), smooth.alias("purity"))
        depth += 1


def judge(spark: SparkSession, pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` for every row of ``pages (page_id, url)``."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = seen.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("shape", _shape(F.col("path")))
    seen = seen.withColumns({"said": verdict_of_rule(F.col("rule"), rules),
                             "key": F.concat(F.col("host"), F.lit("\n"), F.concat_ws("/", "shape"))})
    seen = written(spark, seen, "url_pages")
    blocked = F.when(F.col("said") == "block", 1).otherwise(0)
    tree = template_tree(spark, seen.select("key", "host", "shape", blocked.alias("blocked")))
    out = hot_join(seen, tree, "key", "n", seen.count())
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("said", F.when(F.col("purity") > REJECT, "block").otherwise("allow")).alias("verdict"),
                      "template")
