import re

from pyspark.sql import types as T

from sweepframe.llm import url_filter as U

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("host", T.StringType()), T.StructField("n", T.StringType())])


def judged(spark, urls):
    df = spark.createDataFrame([(i, u, "h", "n") for i, u in enumerate(urls)], SCHEMA)
    return sorted(U.judge(spark, df, RULES).collect(), key=lambda r: r.page_id)


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [r for _, r in RULES for h, p in [(r[:r.index("/")], r[r.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=len, default=None)


def test_rules_against_brute_force(spark):
    urls = [None, "", "no scheme", "http://", "http://NET/x", "http://a.net", "http://a.net/", "http://example.net/en/1",
            "http://b.Example.NET/en/1?q", "http://badexample.net/en/1", "https://example.com/de/", "https://example.com/de",
            "https://x.example.com/de/5#t", "ftp://w.org/fr/a/b/c/d/e", "http://w.org?x=/fr/", "http://É.org/fr/", "a://b://net/",
            "http://u@h:80/p;q", "http://net/" + "y/" * 3000, "http://example.com/de/\nx", "http://net/", "http://net/"]
    for u, r in zip(urls, judged(spark, urls)):
        h, p = parsed(u)
        assert (r.host, r.path, r.rule) == (h, p, rule(h, p)), u
        if r.rule:
            assert r.verdict == dict((n, v) for v, n in RULES)[r.rule]


def test_templates_learn_from_labels(spark):
    """Blocked templates take unlabelled pages of their shape along; others stay."""
    urls = [f"http://a.example.com/de/{i}" for i in range(30)] + [f"http://a.example.com/en/{i}" for i in range(30)]
    urls += [f"http://b.net/x/{i}" for i in range(30)] + ["http://b.net", "http://b.net?x", "http://a.example.com/en"]
    out = {r.page_id: r for r in judged(spark, urls)}
    assert all(out[i].verdict == "block" for i in range(30))
    assert all(out[i].verdict == "allow" for i in range(30, 60))
    assert out[90].verdict == out[91].verdict == "block"  # the host's pages are all blocked
    assert out[92].verdict == "allow"
    assert out[0].template == "a.example.com/de/*" and out[35].template == "a.example.com/en/*"


def test_hot_host_and_empty(spark):
    urls = [f"http://hot.org/fr/{i % 7}" for i in range(3000)] + [f"http://h{i}.org/" for i in range(50)]
    out = judged(spark, urls)
    assert len(out) == 3050 and {r.verdict for r in out} == {"allow"}
    assert judged(spark, []) == []


def test_families_are_told_apart_at_any_depth(spark):
    """The same two families of pages get the same verdicts however deep they lie."""
    for above in ("", "/a", "/a/b", "/a/b/c", "/a/b/c/d/e/f/g"):
        base = "http://x.example.com/de/" + above.lstrip("/") + ("/" if above else "")
        urls = [f"http://w.org{above}/good/{i}" for i in range(30)]
        urls += [f"http://b.net{above}/bad/{i}" for i in range(30)] + [f"{base}bad/{i}" for i in range(30)]
        urls += [f"http://x.example.com/en{above}/good/{i}" for i in range(30)]
        out = judged(spark, urls)
        assert [r.verdict for r in out] == ["allow"] * 30 + ["block"] * 60 + ["allow"] * 30
        assert not any("**" in r.template for r in out)


def test_similar_siblings_merge_with_each_other(spark):
    """Two classes of siblings, none of which differs from the parent by itself."""
    rows = [(f"s{k}/{i}", "host", [f"s{k}", str(i)], 1 if i < (6 if k < 20 else 2) else 0) for k in range(40) for i in range(8)]
    tree = U.template_tree(spark, spark.createDataFrame(rows, "key string, host string, shape array<string>, blocked int"))
    first = {r.key: r.template.split("/")[1] for r in tree.collect()}
    assert {first[f"s{k}/0"] for k in range(20)} == {"*2"} and {first[f"s{k}/0"] for k in range(20, 40)} == {"*1"}
