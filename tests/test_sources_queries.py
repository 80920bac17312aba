"""Feeds, repositories, extraction and the registered queries."""

import html
import random

from pyspark.sql import functions as F

import __spark_entry__ as se
from docweave.functions import text as T
from docweave.operators import documents as P
from docweave.operators import extract as X
from docweave.sources import feeds as FD
from docweave.sources import repos as R

from conftest import SMALL

FEED = ('<rss xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'
        "<item><title> A  b </title><link>https://medium.com/p/1?utm_source=rss&amp;x=1</link>"
        "<description>&lt;p&gt;D&lt;/p&gt;</description><pubDate>Mon, 01 Jan 2024 23:30:00 -0500</pubDate></item>"
        "<item><title>no link</title></item>"
        "<item><title>ftp</title><link>ftp://x/y</link></item></channel></rss>")


def test_feed_items(spark):
    df = spark.createDataFrame([(1, FEED), (2, "<rss><channel><item><broken")], "id long, xml string")
    rows = FD.feed_items(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.link, r.title, r.description, r.content) == ("https://medium.com/p/1?x=1", "A b", "D", "D")
    assert r.feed_url == "https://medium.com/feed/p"


def test_feed_items_beside_the_channel(spark):
    rdf = ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"><channel rdf:about="c"><title>C</title></channel>'
           '<item rdf:about="1"><title>A</title><link>https://h/1</link></item><item><title>B</title><link>https://h/2</link></item></rdf:RDF>')
    both = ('<rss><channel><item><link>https://h/3</link></item></channel><item><link>https://h/4</link></item></rss>')
    rows = FD.feed_items(spark.createDataFrame([(1, rdf), (2, both)], "id long, xml string")).collect()
    assert sorted((r.id, r.item_pos, r.link, r.title) for r in rows) == [
        (1, 0, "https://h/1", "A"), (1, 1, "https://h/2", "B"), (2, 0, "https://h/3", None), (2, 1, "https://h/4", None)]


def test_feed_lookup_keeps_one_entry(spark):
    items = spark.createDataFrame([("u2", 0, "l", "b", None, "x", None), ("u1", 1, "l", "a", None, "y", None), ("u1", 0, "l", "first", None, "z", None)],
                                  "feed_url string, item_pos int, link string, title string, description string, content string, published_at string")
    links = spark.createDataFrame([(1, "l"), (2, "other")], "seq long, link string")
    got = {r.seq: r.title for r in FD.lookup_entries(links, items).collect()}
    assert got == {1: "first", 2: None} and FD.lookup_entries(links, items).count() == 2


FILE = "file_id long, repo string, path string, size_bytes long, text string"


def test_readme_pick(spark):
    rows = [(1, "r", "readme.md", 5, "x"), (2, "r", "README.rst", 5, "y"), (3, "r", "README.md", 5, "   "),
            (4, "q", "docs/ReadMe.txt", 3, "z"), (5, "q", ".git/readme", 3, "g")]
    got = {r.repo: (r.readme_path, r.readme) for r in R.readme_pick(spark.createDataFrame(rows, FILE)).collect()}
    assert got == {"r": ("README.rst", "y"), "q": ("docs/ReadMe.txt", "z")}


def corpora(spark, rows, **limits):
    files = [(i, repo, path, size, text) for i, (repo, path, size, text) in enumerate(rows)]
    return {r.repo: (r.corpus, r.trimmed, r.files) for r in R.repository_corpus(spark.createDataFrame(files, FILE), **limits).collect()}


def test_repository_corpus_worked_cases(spark):
    got = corpora(spark, [
        ("plain", "b", 1, "two"), ("plain", "a", 1, "one"), ("plain", "c", 1, "  "),
        ("big", "a", 999, "one"), ("big", "b", 1, "two"),
        ("cut", "a", 1, "x" * 12),
        ("skip", "a", 1, "x" * 9), ("skip", "b", 1, "x" * 9), ("skip", "c", 1, "y"),  # b passes 18 characters, c still fits
        ("none", ".git/a", 1, "x"), ("none", "i.png", 1, "x"),
        ("blank", "a", 1, ""),
    ], max_file_chars=10, max_total_chars=18, skip_bytes=100)
    empty = "FILE: README\nNo text content extracted from repository after ETL size and file filters."
    assert got == {
        "plain": ("FILE: a\none\n\nFILE: b\ntwo", False, 2),
        "big": ("FILE: b\ntwo", True, 1),
        "cut": (empty, True, 1),  # 1 + 10 + 15 characters pass the total
        "skip": ("FILE: a\n" + "x" * 9 + "\n\nFILE: c\ny", True, 2),
        "none": (empty, False, 1),
        "blank": (empty, False, 1),
    }


def test_repository_corpus_budgets(spark):
    rows = [("hot", f"f{i % 50:03d}", 1, "x" * (i % 7 + 1)) for i in range(600)] + [("few", f"g{i}", 1, "y") for i in range(3)]
    got = corpora(spark, rows, max_files=40, max_total_chars=200)
    assert set(got) == {"hot", "few"} and got["few"][1:] == (False, 3)
    corpus, trimmed, files = got["hot"]
    blocks = corpus.split("\n\n")
    assert trimmed and files == len(blocks) <= 40
    assert sum(len(b) - len("FILE: \n") for b in blocks) <= 200


PAGE = ('<html><head><meta content="Og T" property="og:title"><meta name="keywords" content="A, B,,c">'
        '<meta name="description" content=" Desc &amp; more &#8212; "><title>T &amp; x</title>'
        '<meta property="article:published_time" content="2024-02-01T23:30:00-05:00"></head>'
        '<body><nav>menu</nav><article><h1 class="a top-card-layout__title">Engineer</h1><p>Body &rsquo;s</p>'
        '<div class="topcard__flavor-row"><span>Acme</span></div><script>x=1</script></article><h2>Sub</h2>'
        '<a class="topic-tag">LLM</a><a class="topic-tag z"> llm </a><div class="markdown-body">Read<b>me</b></div></body></html>')


def test_native_page_fields(spark):
    df = spark.createDataFrame([(1, "https://h/x", PAGE), (2, "https://h/y", "no markup"), (3, "https://h/z", None),
                                (4, "https://h/w", "<p>" * 5000 + "deep")], "id long, link string, html string")
    f = {r.id: r for r in X.page_fields(df).withColumn("main", X.main_text(F.col("html"))).collect()}
    assert (f[1].html_title, f[1].description, f[1].tags) == ("Og T", "Desc & more \u2014", ["a", "b", "c"])
    assert str(f[1].published_date) == "2024-02-01"
    assert [f[i].main for i in (1, 2, 3, 4)] == ["Engineer\nBody \u2019s\nAcme", "no markup", None, "deep"]
    job = X.job_records(df.filter("id = 1")).first()
    assert job.title == "Engineer" and job.tags == ["Acme"] and job.content == "Job title: Engineer\n\nCompany: Acme"
    assert job.raw_metadata == {"company": "Acme", "location": None} and job.platform == "linkedin"
    rendered = X.rendered_article_records(df.filter("id = 1")).first()
    assert rendered.title == "Engineer" and rendered.content.startswith("Sub\n\n") and rendered.challenge_reason is None
    repo = X.repository_page_fields(df.filter("id = 1")).first()
    assert repo.topics == ["llm"] and repo.readme == "Read\nme"


def test_nested_elements_are_whole(spark):
    main = {
        "<div role=main><div>Head</div><p>First</p><div><div>In</div></div>Last</div><p>Out</p>": "Head\nFirst\nIn\nLast",
        "<article>A<article class='card'>B</article><article/>C</article>D": "A\nB\nC",
        "<article-list>N</article-list><main>M<ARTICLE>x<article >y</article>z</ARTICLE></main>": "x\ny\nz",
        "<main><main>é😀</main> tail</main>out": "é😀\ntail",
        "<article>never <div>closed</div>": "never\nclosed",
        "<body><article/><p>b</p></body>": "",
    }
    rows = spark.createDataFrame([(h,) for h in main], "html string").select("html", X.main_text(F.col("html")).alias("t")).collect()
    assert {r.html: r.t for r in rows} == main
    job = ('<div class="topcard__flavor-row"></div><span>Out</span><div class="topcard__flavor-row"><div></div><span>A<span>cme</span> Co</span></div>'
           '<ul><li class="description__job-criteria-item">Level<ul><li class="description__job-criteria-item">One</li></ul>end</li><li>other</li></ul>'
           '<div class="show-more-less-html__markup"><div>Head</div><section><div>Mid</div></section>Tail</div><div>Similar</div>')
    r = X.job_records(spark.createDataFrame([("l", job)], "link string, html string")).first()
    assert r.content == ("Job title: l\n\nCompany: A cme Co\n\nLevel One end\nOne\n\nHead Mid Tail")
    readme = '<div id="readme"><div class="x">One</div><div>Two<div>Three</div></div>Four</div>Five'
    body = '<article class="markdown-body"><article>a</article>b</article>c<div class="markdown-body">d</div>'
    got = X.repository_page_fields(spark.createDataFrame([(1, readme), (2, body)], "id long, html string")).collect()
    assert {x.id: x.readme for x in got} == {1: "One\nTwo\nThree\nFour", 2: "a\nb"}


def test_repository_selectors_of_any_tag(spark):
    pages = ['<a data-view-component="true" href="/topics/llm">LLM</a><a class="topic-tag">rag</a><a data-view-component="true" href="/x">no</a>'
             '<a href="https://github.com/topics/Agents" data-view-component=true>Agents</a><a href="/topics/no">no</a>'
             '<p id="readme-x">no</p><section id="readme">Read<section>me</section>now</section>out', '<img id=readme>rest']
    got = X.repository_page_fields(spark.createDataFrame(list(enumerate(pages)), "id long, html string")).orderBy("id").collect()
    assert [(r.readme, r.topics) for r in got] == [("Read\nme\nnow", ["llm", "rag", "agents"]), ("", [])]
    html = "<body><p>no</p><section role='main'>A<section>B</section>C</section>D</body>"
    assert spark.createDataFrame([(html,)], "h string").select(X.main_text(F.col("h"))).first()[0] == "A\nB\nC"


def test_class_names_in_any_order(spark):
    page = spark.createDataFrame([("<i class='b  x a'>yes</i><i class=\"ab\">no</i>",), ("<i class='a'>no</i><i class='b'>no</i>",)], "h string")
    got = page.select(X.element(F.col("h"), X.element_pattern("i", X.with_class("a", "b"))).alias("t")).collect()
    assert [r.t for r in got] == ["yes", None]


def test_rendered_challenge_page(spark):
    df = spark.createDataFrame([("https://medium.com/x", "<body><p>Ray ID 7</p><p>by Cloudflare</p></body>")], "link string, html string")
    assert X.rendered_article_records(df).first().challenge_reason == "bot_protection_challenge"


def test_challenge_pages_are_errors(spark, tmp_path):
    body = "<p>" + "Agents read long pages. " * 20 + "</p>"
    pages = {
        # The marks are in the footer, outside the main text.
        1: (f"<title>T</title><main>{body}</main><footer>Ray ID: <b>7</b> by Cloud&#102;lare</footer>", "bot_protection_challenge"),
        # A phrase over several text pieces, in a short page: the challenge is the reason, not the length.
        2: ("<article>Performing<!-- --> <i>security</i><script>x()</script> verification</article>", "bot_protection_challenge"),
        3: (f"<noscript>Enable JavaScript and cookies to continue</noscript><article>{body}</article>", "bot_protection_challenge"),
        # One half of the pair, and marks that are no text of the page.
        4: (f"<article>{body}Ray ID</article>", None),
        5: (f"<script>'ray id'</script><!-- performing security verification --><article title='cloudflare'>{body}</article>", None),
        6: ("<article>short</article>", "insufficient_content: extracted 5 chars"),
        7: (None, "insufficient_content: extracted 0 chars"),
    }
    rows = [(i, f"https://site.org/{i}", html) for i, (html, _) in pages.items()]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.seq: r for r in se.queries()["h9_article_documents"](spark, str(tmp_path)).collect()}
    assert {i: r.status for i, r in got.items()} == {i: "error" if reason else "ready" for i, (_, reason) in pages.items()}
    for i, (_, reason) in pages.items():
        document = [got[i][c] for c in ("title", "collection_name", "content_kind", "ai_relevance_score", "tags")]
        assert document == [None] * 5 if reason else None not in document, i
    records = X.article_records(spark.createDataFrame(rows, "seq long, link string, html string"))
    docs = P.build_documents(records.withColumn("topic_query", F.lit("agentic ai")), topic="agentic ai", failure="challenge_reason")
    assert {r.seq: (r.reason, r.has_document, r.link) for r in docs.collect()} == {
        i: (reason, reason is None, f"https://site.org/{i}") for i, (_, reason) in pages.items()}


def test_entities(spark):
    rng = random.Random(4)
    atoms = ["&copy2", "&copy;", "&amp", "&AMP;lt;", "&notit;", "&notin;", "&Bopf;", "&nosuch;", "&#65", "&#x41;", "&#X1F600;", "&#0;", "&#13;", "&#128;", "&#x80",
             "&#x9F;", "&#129;", "&#xD800;", "&#1114112;", "&#99999999999999999999", "&#xFFFFFFFFFF;", "&#x0000000041;", "&#11;", "&#xFDD0;", "&#x1FFFF;",
             "&#;", "&#x;", "& ", "&", "&&", "&lt", "&ltx;", "&eacute", "&eacute;", "&NotEqualTilde;", "x", " ", ";", "1", "漢", "&hellip;", "&times.", "&Aacuteb"]
    cases = atoms + ["".join(rng.choice(atoms) for _ in range(rng.randint(1, 6))) for _ in range(400)] + ["plain", ""]
    rows = spark.createDataFrame([(c,) for c in cases], "s string").select("s", T.html_unescape("s").alias("t")).collect()
    for r in rows:
        assert r.t == html.unescape(r.s), r.s


def test_enrichment_of_named_columns(spark):
    docs = [(1, "https://a.com/x", "t", "Large language model agents hiring machine learning engineer " * 5, "agentic ai"), (2, "https://b.com/y", "t", "short", "agentic ai")]
    df = spark.createDataFrame(docs, "seq long, link string, title string, content string, topic_query string")
    whole = {r.seq: r for r in P.build_documents(df, topic="agentic ai").collect()}
    for columns in (("collection_name",), ("tags", "ai_relevance_score"), ("summary", "content")):
        part = P.build_documents(df, topic="agentic ai", columns=columns)
        assert set(columns) <= set(part.columns) and not {"ai_topics", "job_roles"} & set(part.columns)
        for r in part.collect():
            assert all(r[c] == whole[r.seq][c] for c in (*columns, "status", "content"))
    plan = P.build_documents(df, topic="agentic ai", columns=()).select("status")._jdf.queryExecution().executedPlan().toString()
    assert "machine learning" not in plan and "Contains" not in plan and "contains" not in plan


def test_entry_and_queries_run(spark):
    assert se.entry(spark).count() > 0
    qs, sqls = se.queries(), se.oracle_sql()
    assert len(sqls) >= 40 and set(sqls) <= set(qs)
    for name in ("m1_merge_actions", "a2_domain_metrics", "l6_job_links", "s7_readme_pick"):
        assert qs[name](spark, SMALL).count() >= 0


def test_determinism_across_partitions(spark):
    q = se.queries()["m1_merge_actions"]
    a = sorted(map(tuple, q(spark, SMALL).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = sorted(map(tuple, q(spark, SMALL).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b
