"""URL functions against the standard library and the edge rows of FIXTURES."""

from urllib.parse import urljoin

from pyspark.sql import functions as F

from docweave.functions import urls as U

BASES = ["http://a/b/c/d;p?q", "https://h.example.com/x/y/", "https://h.example.com",
         "https://arxiv.org/list/cs.AI/recent"]
REFS = ["g:h", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "g;x", "", ".", "./",
        "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "../../../../g", "/./g", "/../g",
        "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", "g;x=1/./y", "g;x=1/../y",
        "https:foo/bar", "http:g", "\t/x", "a\nb/c", "  g", "https://q/w?", "HTTPS://Q/w#", "//q/w?#",
        "/abs/12", "/jobs/view/3?utm_medium=q", "https://github.com/a/b", "a//b/../c", "/la.", "//", "///x", "//?q", ".;p", "..;p", "b;", "g;p;q", "/;x"]


NORMALIZED = {
    "http://h/p?utm_source=a&UTM_X=1&b=&c=1#f": "http://h/p?b=&c=1#f",
    " http://h/p#x ": "http://h/p#x",
    "https://w.com/s/1?utm_source=x&id=1": "https://w.com/s/1?id=1",
    "http://h/p?a=1%20~*&d": "http://h/p?a=1+~%2A&d=",
    "http://h/p?utm_medium=q": "http://h/p",
    "https://x.org/a?q=a+b&r=%2B": "https://x.org/a?q=a+b&r=%2B",
    "\u3000http://h/?x=1 ": "http://h/?x=1",
    "http://h/?q=a%20b%zz&r=%": "http://h/?q=a+b%25zz&r=%25",
}


def test_urljoin_matches_stdlib(spark):
    rows = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(rows, "base string, href string").withColumn("j", U.urljoin_sql("`base`", "href"))
    for r in df.collect():
        assert r.j == urljoin(r.base, r.href), (r.base, r.href)


def test_normalize_link(spark):
    df = spark.createDataFrame([(x,) for x in NORMALIZED], "l string").select("l", U.normalize_link("l").alias("n"))
    assert {r.l: r.n for r in df.collect()} == NORMALIZED


def test_url_parts_and_predicates(spark):
    df = spark.createDataFrame([("https://U@Host:80/a",)], "u string")
    assert df.select(U.host("u")).first()[0] == "u@host:80"
    rows = [("ftp://h/",), ("http://",), ("https://h",)]
    got = [r[0] for r in spark.createDataFrame(rows, "u string").select(U.is_http_url("u")).collect()]
    assert got == [False, False, True]
    src = "https://s/news"
    cands = ["https://s/news/", "https://s/a", "https://s/a/b", "https://s/tag/x", "https://s/x/about-us"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cands], "l string")
           .select(U.is_likely_content_link(F.lit(src), "l")).collect()]
    assert got == [False, False, True, False, False]
    repos = ["https://github.com/a/b", "https://github.com/a", "https://github.com/topics/x", "https://github.com/a/b/c"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in repos], "l string")
           .select(U.is_repository_link("l")).collect()]
    assert got == [True, False, False, False]


def test_feed_urls(spark):
    rows = [("https://medium.com/nlplanet/",), ("https://odsc.medium.com/x?y=1",), ("https://blog.example.com/p",)]
    df = spark.createDataFrame(rows, "u string").select(U.feed_url_for_source("u").alias("s"),
                                                         U.feed_url_for_article("u").alias("a"))
    got = df.collect()
    assert got[0].s == "https://medium.com/feed/nlplanet" and got[0].a == "https://medium.com/feed/nlplanet"
    assert got[1].s == "https://odsc.medium.com/feed" and got[1].a == "https://odsc.medium.com/feed"
    assert got[2].s == "https://blog.example.com/feed" and got[2].a is None


def test_sql_text_over_lambda_variables(spark):
    rows = [(b, r) for b in BASES for r in REFS]
    df = spark.createDataFrame(rows, "base string, href string").withColumn(
        "j", U.urljoin_sql("`base`", "href"))
    for r in df.collect():
        assert r.j == urljoin(r.base, r.href), (r.base, r.href)
    n = spark.createDataFrame([(x,) for x in NORMALIZED], "l string").select(
        "l", F.expr(f"transform(array(l), y -> {U.normalize_text('y')})[0]").alias("a"))
    for r in n.collect():
        assert r.a == NORMALIZED[r.l]
