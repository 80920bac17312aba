"""Record-shaped views derived from the driver's tables.

The store this engine serves holds crawled documents, pages, feeds and
repository files.  The driver's tables carry prose, pages and names; these
views give them the shape of those records so every operator runs on data
that grows with the tables.  Each view is plain DataFrame code (scan ->
project), so Catalyst prunes columns and nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

TOPIC = "agentic ai"


def _s(c) -> F.Column:
    return F.col(c).cast("string")


def crawl_docs(spark: SparkSession, data_dir: str) -> DataFrame:
    """One extracted document per row, covering every link family.

    title = first line of the text; content = the whole text; published
    date missing for one document in seven.
    """
    d = read_table(spark, data_dir, "documents", ["doc_id", "text", "lang", "source"])
    i, src = _s("doc_id"), F.col("source")
    fam = F.col("doc_id") % 10
    link = (
        F.when(fam == 0, F.concat(F.lit("https://github.com/"), src, F.lit("/r"), i))
        .when(fam == 1, F.concat(F.lit("https://arxiv.org/abs/"), i))
        .when(fam == 2, F.concat(F.lit("https://www.linkedin.com/jobs/view/"), i))
        .when(fam == 3, F.concat(F.lit("https://medium.com/"), src, F.lit("/"), i))
        .when(fam == 4, F.concat(F.lit("https://www.wired.com/story/"), i, F.lit("?utm_source=x&id="), i))
        .when(fam == 5, F.concat(F.lit("https://"), src, F.lit(".example.com/blog/"), i))
        .when(fam == 6, F.concat(F.lit("https://"), src, F.lit(".example.com/news/"), i))
        .when(fam == 7, F.concat(F.lit("https://x.com/"), src, F.lit("/"), i))
        .when(fam == 8, F.concat(F.lit("https://"), src, F.lit(".example.org/careers/"), i))
        .otherwise(F.concat(F.lit("https://"), src, F.lit(".example.net/"), F.col("lang"), F.lit("/"), i))
    )
    published = F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")))
    return d.select(
        F.col("doc_id").alias("seq"),
        link.alias("link"),
        F.regexp_extract("text", r"^[^\n]*", 0).alias("title"),
        F.col("text").alias("content"),
        published.alias("published_date"),
        F.lit(TOPIC).alias("topic_query"),
        F.col("lang"),
    )


def state(spark: SparkSession, data_dir: str) -> DataFrame:
    """Store content before the run: the non-English documents' links."""
    c = crawl_docs(spark, data_dir).filter(F.col("lang") != "en")
    return c.select(
        "link",
        F.when(F.col("seq") % 2 == 0, "blogs").otherwise("news").alias("collection_name"),
        F.col("seq").alias("state_seq"), "title", "content",
    )


def candidates(spark: SparkSession, data_dir: str) -> DataFrame:
    """Load candidates with their documents, in order; German documents are offered a second time, edited."""
    c = crawl_docs(spark, data_dir)
    first = c.select(
        "seq", "link",
        F.when(F.col("seq") % 4 == 0, "blogs").when(F.col("seq") % 4 == 1, "news")
        .otherwise("github").alias("collection_name"), "title", "content")
    again = c.filter(F.col("lang") == "de").select(
        (F.col("seq") + 1_000_000_000).alias("seq"), "link",
        F.when(F.col("seq") % 5 == 0, "news").otherwise("github").alias("collection_name"),
        "title", F.concat(F.lit("Edited: "), F.col("content")).alias("content"))
    return first.unionByName(again)


def html_docs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Pages with meta description, keywords, publish time, a challenge line
    and four anchor forms; the body carries the whole document text."""
    d = read_table(spark, data_dir, "documents", ["doc_id", "text", "lang", "source"])
    i = _s("doc_id")
    published = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<meta property="article:published_time" content="2024-02-'),
        F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0"),
        F.lit('T23:30:00-05:00">')))
    html = F.concat(
        F.lit("<html><head><title> T"), i, F.lit(' </title><meta name="description" content=" D'), i,
        F.lit(' &copy2 &#x80;&notit; &AMP;lt; &Bopf;&#65 &#xD800; &nosuch; &amp"><meta name="keywords" content="A, '), F.upper("lang"), F.lit(",,"), F.col("source"), F.lit('">'),
        published,
        F.lit("</head><body><article><h1>H</h1><p>"),
        F.regexp_replace("text", '[<>&"]', " "),
        F.lit('</p></article><a class="base-card__full-link" href="/jobs/view/'),
        (F.col("doc_id") % 700).cast("string"),
        F.lit('?utm_medium=q">J</a><a href="https://github.com/'), F.col("source"), F.lit("/r"), i,
        F.lit('">G</a><a href="/abs/'), i, F.lit('">P</a><a href="//cdn.example.com/a/b">C</a>'),
        # Links that other pages hold as well.
        F.lit('<a href="https://github.com/shared/r'), (F.col("doc_id") % 5).cast("string"), F.lit('">G</a><a href="/team/r'),
        (F.col("doc_id") % 3).cast("string"), F.lit('">G</a><a href="/abs/'), (F.col("doc_id") % 4).cast("string"), F.lit('">P</a>'),
        F.when(F.col("doc_id") % 11 == 0, F.lit("<p>Ray ID 1 Cloudflare</p>")).otherwise(F.lit("")),
        F.lit("</body></html>"),
    )
    return d.select("doc_id", html.alias("html"))


def job_docs(spark: SparkSession, data_dir: str) -> DataFrame:
    """Job pages with title, company, location, criteria and description, and the fields they were made of."""
    d = read_table(spark, data_dir, "documents", ["doc_id", "text", "lang", "source"])
    i = _s("doc_id")
    about = F.trim(F.regexp_replace("text", r"[<>&\s\x{A0}]+", " "))
    fields = d.select(
        F.col("doc_id").alias("seq"), F.concat(F.lit("https://www.linkedin.com/jobs/view/"), i).alias("link"),
        F.concat(F.lit("Engineer "), i).alias("title"), F.concat(F.lit("Acme "), F.col("source")).alias("company"),
        F.upper("lang").alias("location"), F.concat(F.lit("Full-time\nLevel "), (F.col("doc_id") % 4).cast("string")).alias("criteria"),
        F.concat(F.lit("About: "), about).alias("about"))
    item = '<li class="description__job-criteria-item"><h3></h3><span> '
    html = F.concat(
        F.lit('<html><head><title>Jobs</title></head><body><h1>Menu</h1><h1 class="x top-card-layout__title">'), F.col("title"),
        F.lit('</h1><div class="topcard__flavor-row"><span class="y">no</span></div><a class="topcard__org-name-link" href="/c"> '),
        F.col("company"), F.lit(' </a><span class="topcard__flavor topcard__flavor--bullet">'), F.col("location"),
        F.lit(f'</span><ul>{item}Full-time</span></li>{item}Level '), (F.col("seq") % 4).cast("string"),
        F.lit(f'</span></li>{item}Full-time</span></li></ul><div class="show-more-less-html__markup"><div><div></div></div><p>'), F.col("about"),
        F.lit("</p></div><div>Similar jobs</div><script>var x = '<h1>no</h1>';</script></body></html>"))
    return fields.withColumn("html", html)


def page_sources(spark: SparkSession, data_dir: str) -> DataFrame:
    """Listing pages with a category and their order: the stored pages with links of every strategy, some
    shared between pages; some blog and news sources lie on a feed host."""
    p = read_table(spark, data_dir, "pages", ["page_id", "url", "html"])
    i, m = F.col("page_id"), F.col("page_id") % 5
    cat = (F.when(m == 0, "blogs").when(m == 1, "github").when(m == 2, "job_postings")
           .when(m == 3, "news").otherwise("research_papers"))
    n = lambda k: (i % k).cast("string")
    url = F.when((i % 20).isin(0, 3), F.concat(F.lit("https://medium.com/src"), (F.floor(i / 20) % 20).cast("string"))).otherwise(F.col("url"))
    links = F.concat(
        F.lit('<a href="/guides/'), _s("page_id"), F.lit('/part-1?utm_source=a&amp;x=1">1</a><a href="/guides/all/part-'), n(4),
        F.lit('">2</a><a href="/guides/'), _s("page_id"), F.lit('/part-1?x=1">1</a><a href="/team'), n(3), F.lit("/r"), n(9),
        F.lit('">r</a><a href="https://github.com/lab/r'), _s("page_id"), F.lit('">r</a><a href="https://arxiv.org/abs/'), n(7),
        F.lit('">p</a><a href="https://arxiv.org/abs/9'), _s("page_id"), F.lit('">p</a><a href="/jobs/view/'), n(11), F.lit('">j</a>'))
    return p.select(i.alias("source_pos"), cat.alias("category"), url.alias("source_url"), F.concat("html", links).alias("html"))


def fallback_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """Lines of a fallback file: the stored URLs, those with a fragment as comments."""
    p = read_table(spark, data_dir, "pages", ["page_id", "url"])
    return p.select(F.col("page_id").alias("pos"), F.when(F.col("url").contains("#"), F.concat(
        F.lit("# "), F.col("url"))).otherwise(F.col("url")).alias("value"))


def repo_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """Files per repository: README variants, source, binary and .git paths."""
    d = read_table(spark, data_dir, "documents", ["doc_id", "text", "source"])
    i = _s("doc_id")
    m = F.col("doc_id") % 5
    path = (F.when(m == 0, F.concat(F.lit("docs/readme-"), i, F.lit(".md")))
            .when(m == 1, F.concat(F.lit("src/f"), i, F.lit(".py")))
            .when(m == 2, F.concat(F.lit("img/p"), i, F.lit(".png")))
            .when(m == 3, F.concat(F.lit(".git/o"), i))
            .when(F.col("doc_id") % 3 == 0, F.lit("README.rst"))
            .when(F.col("doc_id") % 3 == 1, F.lit("readme.md"))
            .otherwise(F.concat(F.lit("lib/n"), i, F.lit(".txt"))))
    return d.select(F.col("doc_id").alias("file_id"), F.col("source").alias("repo"), path.alias("path"),
                    F.length("text").cast("bigint").alias("size_bytes"), "text")


def user_requests(spark: SparkSession, data_dir: str) -> DataFrame:
    """Requested user names with one, two and four tokens (one double space)."""
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    m = F.col("c_custkey") % 3
    name = (F.when(m == 0, F.col("c_name"))
            .when(m == 1, F.concat_ws(" ", "c_name", "c_mktsegment"))
            .otherwise(F.concat(F.col("c_name"), F.lit("  van "), F.col("c_mktsegment"))))
    return c.select(F.col("c_custkey").alias("seq"), name.alias("full_name"), "c_mktsegment")


def existing_users(spark: SparkSession, data_dir: str) -> DataFrame:
    """User dimension before the run: customers of two market segments."""
    return (user_requests(spark, data_dir)
            .filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
            .select("full_name"))


def crawl_results(spark: SparkSession, data_dir: str) -> DataFrame:
    """Run results with ready, error and date-filtered rows."""
    c = crawl_docs(spark, data_dir)
    short = F.length("content") < 120
    status = (F.when(short, "error").when(F.col("published_date") < F.lit("2024-01-10").cast("date"),
                                          "filtered_date_range").otherwise("ready"))
    return c.select(
        "seq", "link", status.alias("status"),
        F.when(~short, F.lower(F.regexp_extract("link", r"^https?://([^/?#]*)", 1))).alias("source_domain"),
        F.when(~short, (F.col("seq") % 11).cast("double") / 10).alias("ai_relevance_score"),
    )


def _feed_strings(spark: SparkSession, data_dir: str) -> DataFrame:
    d = read_table(spark, data_dir, "documents", ["doc_id", "source", "text"])
    i = _s("doc_id")
    body = F.trim(F.regexp_replace("text", r"[<>&\]\s\x{A0}]+", " "))
    xml = F.concat(
        F.lit('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><item><title> T  '),
        i, F.lit(" </title>"),
        F.when(F.col("doc_id") % 9 == 0, F.lit("")).otherwise(F.concat(
            F.lit("<link>https://medium.com/"), F.col("source"), F.lit("/"), i, F.lit("?utm_source=rss</link>"))),
        F.lit("<description>D"), i, F.lit(" &amp;copy2 &amp;#x80;&amp;Bopf;</description><pubDate>Mon, "),
        F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0"),
        F.lit(" Jan 2024 23:30:00 -0500</pubDate>"),
        F.when(F.col("doc_id") % 4 == 0, F.lit("")).otherwise(F.concat(
            F.lit("<content:encoded><![CDATA[<p>C"), i, F.lit(" "), body, F.lit("</p>]]></content:encoded>"))),
        F.when(F.col("doc_id") % 13 == 0, F.lit("<broken")).otherwise(F.lit("</item></channel></rss>")),
    )
    return d.select("doc_id", "source", xml.alias("xml"))


def feed_docs(spark: SparkSession, data_dir: str) -> DataFrame:
    """RSS strings: some malformed, some items without link or full content."""
    return _feed_strings(spark, data_dir).drop("source")


def source_feeds(spark: SparkSession, data_dir: str) -> DataFrame:
    """The feed documents of each feed host's source, in order, three items each, links repeated; some malformed."""
    d = read_table(spark, data_dir, "documents", ["doc_id", "source", "text"])
    i, body = _s("doc_id"), F.trim(F.regexp_replace("text", r"[<>&\]\s\x{A0}]+", " "))

    def item(last, tail: str) -> F.Column:
        return F.concat(F.lit("<item><title>T</title><link>https://medium.com/"), F.col("source"), F.lit("/"), last,
                        F.lit(f"{tail}</link><description>"), body, F.lit("</description></item>"))

    xml = F.concat(F.lit("<rss><channel>"), item(i, "?utm_source=rss"), item((F.col("doc_id") % 7).cast("string"), ""), item(i, ""),
                   F.when(F.col("doc_id") % 13 == 0, F.lit("<broken")).otherwise(F.lit("</channel></rss>")))
    return d.select(F.concat(F.lit("https://medium.com/feed/"), F.col("source")).alias("feed_url"), F.col("doc_id").alias("feed_pos"), xml.alias("xml"))


def run_inputs(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """What a run over the documents' links reads: article, job and rendered feed-host pages, feed documents of three
    items, and repository files.  Some feed articles have a feed entry, some a page, some neither; some
    repositories have a README, some only a fallback one, some none."""
    d = read_table(spark, data_dir, "documents", ["doc_id", "text", "lang", "source"])
    i, src, fam = _s("doc_id"), F.col("source"), F.col("doc_id") % 10
    body = F.trim(F.regexp_replace("text", r"[<>&\]\s\x{A0}]+", " "))
    links = crawl_docs(spark, data_dir).select("seq", "link")
    stamp = F.concat(F.lit("2024-02-"), F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0"))
    story = F.concat(F.lit("<html><head><title>Story "), i, F.lit("</title>"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(
        F.concat(F.lit('<meta property="article:published_time" content="'), stamp, F.lit('T23:30:00-05:00">'))),
        F.lit("</head><body><nav>Menu</nav><article><p>"), body, F.lit("</p></article></body></html>"))
    rendered = F.concat(F.lit("<html><head><title>Site</title></head><body><h1>Post "), i, F.lit("</h1><h2>Sub</h2><p>"), body,
                        F.lit("</p></body></html>"))
    own = d.join(links, d["doc_id"] == links["seq"])
    pages = own.filter(fam.isin(1, 4, 5, 6, 7, 8, 9)).select(F.col("link").alias("url"), story.alias("html")).unionAll(
        own.filter((fam == 3) & (F.col("doc_id") % 30 == 3)).select("link", rendered)).unionAll(
        job_docs(spark, data_dir).filter("seq % 10 = 2").select("link", "html"))

    def item(title, link, day) -> F.Column:
        return F.concat(F.lit("<item><title>"), title, F.lit("</title><link>"), link, F.lit("</link><description>D"), i,
                        F.lit("</description><pubDate>Mon, "), day, F.lit(" Jan 2024 23:30:00 -0500</pubDate><content:encoded><![CDATA[<p>"),
                        body, F.lit("</p>]]></content:encoded></item>"))

    own_day = F.lpad(((F.col("doc_id") % 28) + 1).cast("string"), 2, "0")
    place = F.concat(F.lit("https://medium.com/"), src, F.lit("/"))
    xml = F.concat(F.lit('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'),
                   item(F.lit("Other"), F.concat(place, F.lit("other")), F.lit("01")),
                   item(F.concat(F.lit("Feed "), i), F.concat(place, i, F.lit("?utm_source=rss")), own_day),
                   item(F.lit("Again"), F.concat(place, i), F.lit("02")), F.lit("</channel></rss>"))
    feeds = d.filter((fam == 3) & (F.col("doc_id") % 30 == 23)).select(
        F.concat(F.lit("https://medium.com/feed/"), src).alias("feed_url"), F.col("doc_id").alias("feed_pos"), xml.alias("xml"))
    named = F.when(F.col("doc_id") % 20 == 0, "README.md").when(F.col("doc_id") % 60 == 30, "src/main.py").otherwise("docs/readme-first.md")
    files = F.array(*[F.struct(F.lit(k).alias("k"), path.alias("path"), text.alias("text")) for k, (path, text) in enumerate((
        (F.lit("src/a.py"), body), (named, body), (F.lit(".git/readme.md"), F.lit("no")), (F.lit("README.txt"), F.lit("  "))))])
    repo_files = own.filter(fam == 0).select("link", "doc_id", F.inline(files)).select(
        F.col("link").alias("repo"), (F.col("doc_id") * 4 + F.col("k")).alias("file_id"), "path", F.length("text").cast("long").alias("size_bytes"), "text")
    return {"links": links, "pages": pages, "feeds": feeds, "repo_files": repo_files}


VIEWS = {
    "crawl_docs": crawl_docs, "state": state, "candidates": candidates, "html_docs": html_docs, "job_docs": job_docs,
    "page_sources": page_sources, "repo_files": repo_files, "user_requests": user_requests,
    "existing_users": existing_users, "crawl_results": crawl_results, "feed_docs": feed_docs,
}
