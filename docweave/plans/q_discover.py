"""Discovery and URL queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions import urls as U
from ..operators import discover as L
from ..sources import views as V
from . import oracle_urls as O
from .oracle_enrich import q
from .registry import register

GITHUB_BASE = "https://github.com"
PAPER_BASE = D.CURATED_SOURCE_LINKS["research_papers"][0]
JOB_BASE = "https://www.linkedin.com"
MAX_LINKS = 28  # 6,6,6,5,5: exercises the round-robin extras of L11

_ANC_PAGES = O.anchors_sql("page_sources", "category, source_pos, source_url")
_ANC_HTML = O.anchors_sql("html_docs", "doc_id")


@register("l1_anchors", "SELECT source_pos, pos, href, anchor_class FROM anc", {"anc": _ANC_PAGES})
def l1_anchors(spark: SparkSession, sf: str) -> DataFrame:
    """L1: anchors with href of every listing page, in document order."""
    a = L.anchors(V.page_sources(spark, sf))
    return a.select("source_pos", F.col("pos").cast("bigint").alias("pos"), "href", "anchor_class")


@register("l2_resolve_links", f"""
SELECT doc_id, pos, href, {O.join_simple(q(PAPER_BASE), 'href')} AS link FROM anc
""", {"anc": _ANC_HTML})
def l2_resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    """L2: anchors resolved against a listing URL (absolute, //host, rooted)."""
    a = L.anchors(V.html_docs(spark, sf))
    return a.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "href",
                    U.urljoin_sql(U.base_sql(PAPER_BASE), "href").alias("link"))


_L3_CTES = {
    "anc": _ANC_PAGES,
    "c": f"SELECT category, source_pos, pos, source_url, {O.normalize(O.join_simple('source_url', 'href'))} AS link FROM anc",
    "f": f"""SELECT * FROM c WHERE {O.is_http('link')} AND {O.host('link')} = {O.host('source_url')}
AND {O.likely_content('source_url', 'link', 2)}""",
    "d": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_pos, link ORDER BY pos) AS rn FROM f)
WHERE rn = 1""",
    "r": "SELECT *, row_number() OVER (PARTITION BY source_pos ORDER BY pos) AS source_rank FROM d",
    "n": "SELECT category, count(*) AS n FROM page_sources GROUP BY category",
}


@register("l3_same_host_links", "SELECT source_pos, pos, link, source_rank FROM r WHERE source_rank <= 3", _L3_CTES)
def l3_same_host_links(spark: SparkSession, sf: str) -> DataFrame:
    """L3 (+L1, L2, U2, P6, P7, P8, W1, W2): same-host content links per page, first 3."""
    out = L.same_host_links(V.page_sources(spark, sf), 3)
    return out.select("source_pos", F.col("pos").cast("bigint").alias("pos"), "link",
                      F.col("source_rank").cast("bigint").alias("source_rank"))


_FEED_CTES = {
    "fi": """SELECT feed_url, link, min((feed_pos, item_pos)) AS spot FROM source_items GROUP BY ALL""",
    "fr": """SELECT category, source_pos, link, row_number() OVER (PARTITION BY source_pos ORDER BY spot) AS source_rank
FROM page_sources JOIN fi ON fi.feed_url = 'https://medium.com/feed' || substr(source_url, 19)
WHERE starts_with(source_url, 'https://medium.com/')""",
    "sl": f"""SELECT category, source_pos, pos, link, source_rank FROM r WHERE NOT contains({O.host('source_url')}, 'medium.com')
UNION ALL SELECT category, source_pos, source_rank - 1, link, source_rank FROM fr""",
}


def _expand_sql(cat: str, limit: int) -> str:
    return f"""SELECT * FROM (
  SELECT sl.category, sl.source_pos, sl.pos, sl.link,
         row_number() OVER (PARTITION BY sl.category ORDER BY sl.source_pos, sl.pos) AS category_rank_pos
  FROM sl JOIN n USING (category)
  WHERE sl.category = '{cat}' AND sl.source_rank <= greatest(2, ceil({limit} / n.n)))
WHERE category_rank_pos <= {limit}"""


@register("l8_expand_sources", f"""
SELECT category, source_pos, pos, link, category_rank_pos FROM ({_expand_sql('blogs', 6)})
UNION ALL
SELECT category, source_pos, pos, link, category_rank_pos FROM ({_expand_sql('news', 5)})
""", {**_L3_CTES, **_FEED_CTES})
def l8_expand_sources(spark: SparkSession, sf: str) -> DataFrame:
    """L8 (+L9, L3, L7, W3): blogs and news expansion over their listing pages and feeds."""
    out = L.expand_sources(V.page_sources(spark, sf), {"blogs": 6, "news": 5}, feeds=V.source_feeds(spark, sf))
    return out.select("category", "source_pos", F.col("pos").cast("bigint").alias("pos"), "link",
                      F.col("category_rank_pos").cast("bigint").alias("category_rank_pos"))


def _fold_ctes(name: str, candidates: str, limit: int, cap: int) -> dict[str, str]:
    """L4/L5 as the walk they describe, one candidate per step: CTEs ending in ``{name}_out``."""
    kind = "STRUCT(source_pos BIGINT, pos BIGINT, link VARCHAR)[]"
    take = (f"(len(list_filter(taken, lambda t: t.link = o.link)) = 0 AND len(taken) < {limit} "
            f"AND CASE WHEN f.src = o.source_pos THEN n ELSE 0 END < {cap})")
    return {
        f"{name}_o": f"""SELECT row_number() OVER (ORDER BY source_pos, pos) AS k, CAST(source_pos AS BIGINT) AS source_pos,
  CAST(pos AS BIGINT) AS pos, link FROM ({candidates})""",
        f"{name}_f": f"""SELECT CAST(0 AS BIGINT) AS k, CAST([] AS {kind}) AS taken, CAST(-1 AS BIGINT) AS src, 0 AS n
UNION ALL
SELECT o.k, CASE WHEN {take} THEN list_append(taken, {{'source_pos': o.source_pos, 'pos': o.pos, 'link': o.link}}) ELSE taken END,
  o.source_pos, CASE WHEN f.src = o.source_pos THEN n ELSE 0 END + CASE WHEN {take} THEN 1 ELSE 0 END
FROM {name}_f f JOIN {name}_o o ON o.k = f.k + 1 WHERE len(taken) < {limit}""",
        f"{name}_out": f"""SELECT t.source_pos, t.pos, t.link FROM (SELECT unnest(taken) AS t FROM (SELECT taken FROM {name}_f ORDER BY k DESC LIMIT 1))""",
    }


def _candidates_sql(src: str, base: str, pred, where: str = "true") -> str:
    return f"""SELECT source_pos, pos, link FROM (
  SELECT source_pos, pos, {O.normalize(O.join_simple(base, 'href'))} AS link FROM {src} WHERE {where}) WHERE {pred('link')}"""


_HTML_AT = "(SELECT doc_id AS source_pos, pos, href FROM anc)"


def _capped(spark: SparkSession, sf: str, category: str, how: str) -> DataFrame:
    pages = V.html_docs(spark, sf).select(F.lit(how).alias("strategy"), F.lit(category).alias("category"), F.col("doc_id").alias("source_pos"),
                                          F.lit(PAPER_BASE).alias("source_url"), "html")
    out = L.capped_links(L.listing_candidates(pages), {category: (6, 2)})
    return out.select("source_pos", F.col("pos").cast("bigint").alias("pos"), "link")


@register("l4_repo_links", "SELECT * FROM repo_out",
          {"anc": _ANC_HTML, **_fold_ctes("repo", _candidates_sql(_HTML_AT, q(GITHUB_BASE), O.is_repo), 6, 2)})
def l4_repo_links(spark: SparkSession, sf: str) -> DataFrame:
    """L4 (+P9): repository links, distinct across sources, per-source cap 2, limit 6.

    A link cut by one source's cap stays free for later ones; pages share links."""
    return _capped(spark, sf, "github", "repositories")


@register("l5_paper_links", "SELECT * FROM paper_out",
          {"anc": _ANC_HTML, **_fold_ctes("paper", _candidates_sql(_HTML_AT, q(PAPER_BASE), O.is_paper), 6, 2)})
def l5_paper_links(spark: SparkSession, sf: str) -> DataFrame:
    """L5 (+P10): paper links with the same caps as L4."""
    return _capped(spark, sf, "research_papers", "papers")


def _jobs_sql(limit: int) -> str:
    link = O.normalize(O.join_simple(q(JOB_BASE), "href"))
    return f"""SELECT page_index, pos, link FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY page_index, pos) AS rn FROM (
    SELECT doc_id AS page_index, pos, {link} AS link FROM anc
    WHERE regexp_matches(anchor_class, '(^|\\s){D.JOB_ANCHOR_CLASS}(\\s|$)') OR contains(href, '{D.JOB_ANCHOR_HREF_PART}'))
  WHERE {O.is_http('link')})
WHERE rn = 1 ORDER BY page_index, pos LIMIT {limit}"""


@register("l6_job_links", _jobs_sql(6), {"anc": _ANC_HTML})
def l6_job_links(spark: SparkSession, sf: str) -> DataFrame:
    """L6 (+P11, U14 in the search URL): job links over result pages, distinct, first 6."""
    pages = V.html_docs(spark, sf).withColumnRenamed("doc_id", "page_index")
    out = L.job_links(pages, 6, JOB_BASE)
    return out.select("page_index", F.col("pos").cast("bigint").alias("pos"), "link")


def _page_jobs_sql(limit: int) -> str:
    return f"""SELECT source_pos, pos, link FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY source_pos, pos) AS rn FROM (
    SELECT source_pos, pos, {O.normalize(O.join_simple(q(JOB_BASE), 'href'))} AS link FROM anc WHERE category = 'job_postings'
      AND (regexp_matches(anchor_class, '(^|\\s){D.JOB_ANCHOR_CLASS}(\\s|$)') OR contains(href, '{D.JOB_ANCHOR_HREF_PART}')))
  WHERE {O.is_http('link')})
WHERE rn = 1 ORDER BY source_pos, pos LIMIT {limit}"""


_L12_CTES = {
    **_L3_CTES, **_FEED_CTES,
    # Sources outnumber the quotas, so every cap is 1.
    **_fold_ctes("repo", _candidates_sql("anc", q(GITHUB_BASE), O.is_repo, "category = 'github'"), 6, 1),
    **_fold_ctes("paper", _candidates_sql("anc", "source_url", O.is_paper, "category = 'research_papers'"), 5, 1),
    "parts": f"""
SELECT 0 AS category_rank, source_pos, pos, link FROM ({_expand_sql('blogs', 6)})
UNION ALL SELECT 1, source_pos, pos, link FROM repo_out
UNION ALL SELECT 2, source_pos, pos, link FROM ({_page_jobs_sql(6)})
UNION ALL SELECT 3, source_pos, pos, link FROM ({_expand_sql('news', 5)})
UNION ALL SELECT 4, source_pos, pos, link FROM paper_out""",
}
_L12_SQL = f"""
SELECT CAST(category_rank AS BIGINT) AS category_rank, source_pos, pos, link FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY category_rank, source_pos, pos) AS rn
  FROM (SELECT category_rank, source_pos, pos, {O.normalize('link')} AS link FROM parts)
  WHERE {O.is_http('link')})
WHERE rn = 1 ORDER BY category_rank, source_pos, pos LIMIT {MAX_LINKS}"""


@register("l12_discover_links", _L12_SQL, _L12_CTES)
def l12_discover_links(spark: SparkSession, sf: str) -> DataFrame:
    """L12 (+L10, L11, L3-L9, W1, W3, W7, M4): balanced discovery over the listing pages and feeds, target 28."""
    found = L.category_links(V.page_sources(spark, sf), MAX_LINKS, feeds=V.source_feeds(spark, sf))
    out = L.discover(found, MAX_LINKS)
    return out.select(F.col("category_rank").cast("bigint").alias("category_rank"), "source_pos", "pos", "link")


@register("s11_source_registry", "SELECT category, source_pos, source_url FROM (VALUES " + ", ".join(
    f"({q(c)}, CAST({i} AS BIGINT), {q(u)})" for c, urls in D.CURATED_SOURCE_LINKS.items() for i, u in enumerate(urls))
    + ") AS t(category, source_pos, source_url) WHERE source_url NOT IN (SELECT url FROM pages)")
def s11_source_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The curated registry as a table; its sources that no page is stored for."""
    from ..sources.tables import read_table
    stored = read_table(spark, sf, "pages", ["url"]).withColumnRenamed("url", "source_url")
    return L.source_registry(spark).join(stored, "source_url", "left_anti").select("category", "source_pos", "source_url")


def _run_links(spark: SparkSession, sf: str, manual: DataFrame, registry: DataFrame) -> DataFrame:
    """X2's link list with a registry, its stored pages and feeds, and a fallback file (the stored URLs, some as comments)."""
    pages = V.page_sources(spark, sf).select(F.col("source_url").alias("url"), "html")
    lines = V.fallback_lines(spark, sf)
    return L.run_links(spark, manual, registry, pages, V.source_feeds(spark, sf), lines, MAX_LINKS)


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    return V.page_sources(spark, sf).select("category", "source_pos", "source_url")


@register("x2_manual_links", """
SELECT min(page_id) AS seq, trim(url) AS link FROM pages WHERE page_id % 4 <> 0 GROUP BY trim(url)""")
def x2_manual_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links are given, so neither the registry nor the fallback counts."""
    from ..sources.tables import read_table
    manual = read_table(spark, sf, "pages", ["page_id", "url"]).select(
        F.col("page_id").alias("pos"), F.when(F.col("page_id") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "url")).alias("link"))
    return _run_links(spark, sf, manual, _registry(spark, sf))


@register("x2_discovered_links", f"""
SELECT (CAST(1 AS BIGINT) << 40) + row_number() OVER (ORDER BY category_rank, source_pos, pos) AS seq, link FROM ({_L12_SQL})""", _L12_CTES)
def x2_discovered_links(spark: SparkSession, sf: str) -> DataFrame:
    """Only blank links are given, so the registry's listing pages and feeds are used."""
    from ..sources.tables import read_table
    manual = read_table(spark, sf, "pages", ["page_id"]).select(F.col("page_id").alias("pos"), F.lit(" \t ").alias("link"))
    return _run_links(spark, sf, manual, _registry(spark, sf))


@register("x2_fallback_links", f"""
SELECT (CAST(1 AS BIGINT) << 40) + pos AS seq, link FROM (
  SELECT page_id AS pos, trim(CASE WHEN contains(url, '#') THEN '# ' || url ELSE url END) AS link FROM pages)
WHERE link <> '' AND NOT starts_with(link, '#') AND regexp_matches(link, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]')
ORDER BY pos LIMIT {MAX_LINKS}""")
def x2_fallback_links(spark: SparkSession, sf: str) -> DataFrame:
    """No page of the curated registry is stored, nothing is discovered, the fallback file counts."""
    return _run_links(spark, sf, spark.createDataFrame([], "pos long, link string"), L.source_registry(spark))


@register("l14_feed_url_source", f"""
SELECT source_pos, CASE WHEN {O.host('source_url')} IN ('medium.com', 'www.medium.com')
  THEN {O.unsplit(O.scheme('source_url'), O.netloc('source_url'), "'/feed' || rtrim(" + O.spath('source_url') + ", '/')", "''", "''")}
  ELSE {O.unsplit(O.scheme('source_url'), O.netloc('source_url'), "'/feed'", "''", "''")} END AS feed_url
FROM page_sources""")
def l14_feed_url_source(spark: SparkSession, sf: str) -> DataFrame:
    """Feed URL of each listing page."""
    return V.page_sources(spark, sf).select("source_pos", U.feed_url_for_source("source_url").alias("feed_url"))


_p = "rtrim(" + O.spath("link") + ", '/')"
_first = f"split_part(ltrim({_p}, '/'), '/', 1)"


@register("l15_feed_url_article", f"""
SELECT seq, CASE WHEN {_p} = '' THEN NULL
  WHEN {O.host('link')} IN ('medium.com', 'www.medium.com') AND {_first} = '' THEN NULL
  WHEN {O.host('link')} IN ('medium.com', 'www.medium.com')
    THEN {O.unsplit(O.scheme('link'), O.netloc('link'), "'/feed/' || " + _first, "''", "''")}
  WHEN ends_with({O.host('link')}, '.medium.com') THEN {O.unsplit(O.scheme('link'), O.netloc('link'), "'/feed'", "''", "''")}
  END AS feed_url
FROM crawl_docs""")
def l15_feed_url_article(spark: SparkSession, sf: str) -> DataFrame:
    """Feed URL that lists each document's article link (null when none)."""
    return V.crawl_docs(spark, sf).select("seq", U.feed_url_for_article("link").alias("feed_url"))


@register("u1_url_parts", f"""
SELECT page_id, {O.scheme('url')} AS scheme, {O.host('url')} AS host, {O.path('url')} AS path,
  {O.part('url', 4)} AS query, {O.part('url', 5)} AS fragment FROM pages""")
def u1_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Scheme, host (lower-cased authority), path, query, fragment."""
    from ..sources.tables import read_table
    p = read_table(spark, sf, "pages", ["page_id", "url"])
    return p.select("page_id", U.scheme("url").alias("scheme"), U.host("url").alias("host"),
                    U.path("url").alias("path"), U.query("url").alias("query"), U.fragment("url").alias("fragment"))


@register("u2_normalize_link", f"""
SELECT 'page' AS src, page_id AS id, {O.normalize('url')} AS link FROM pages
UNION ALL SELECT 'doc', seq, {O.normalize('link')} FROM crawl_docs
UNION ALL SELECT 'anchor', doc_id * 100 + pos, {O.normalize(O.join_simple(q(JOB_BASE), 'href'))} FROM anc""",
          {"anc": _ANC_HTML})
def u2_normalize_link(spark: SparkSession, sf: str) -> DataFrame:
    """Utm parameters removed, other pairs re-encoded in order."""
    from ..sources.tables import read_table
    p = read_table(spark, sf, "pages", ["page_id", "url"]).select(
        F.lit("page").alias("src"), F.col("page_id").alias("id"), U.normalize_link("url").alias("link"))
    d = V.crawl_docs(spark, sf).select(F.lit("doc").alias("src"), F.col("seq").alias("id"),
                                       U.normalize_link("link").alias("link"))
    a = L.resolve_hrefs(L.anchors(V.html_docs(spark, sf)), JOB_BASE).select(
        F.lit("anchor").alias("src"), (F.col("doc_id") * 100 + F.col("pos")).alias("id"), "link")
    return p.unionByName(d).unionByName(a)


@register("p6_p10_link_predicates", f"""
SELECT doc_id, pos, link, {O.is_http('link')} AS is_http, {O.host('link')} = {O.host(q(PAPER_BASE))} AS same_host,
  {O.likely_content(q(PAPER_BASE), 'link', 2)} AS likely_content, {O.is_repo('link')} AS is_repository,
  {O.is_paper('link')} AS is_paper
FROM (SELECT doc_id, pos, {O.join_simple(q(PAPER_BASE), 'href')} AS link FROM anc)""", {"anc": _ANC_HTML})
def p6_p10_link_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """P6, P7 (default depth 2), P8, P9, P10 on resolved anchors."""
    a = L.anchors(V.html_docs(spark, sf)).withColumn("link", U.urljoin_sql(U.base_sql(PAPER_BASE), "href"))
    a = L.fence(a, ["link"])
    b = F.lit(PAPER_BASE)
    return a.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "link",
                    U.is_http_url("link").alias("is_http"), U.same_host(b, "link").alias("same_host"),
                    U.is_likely_content_link(b, "link").alias("likely_content"),
                    U.is_repository_link("link").alias("is_repository"), U.is_paper_link("link").alias("is_paper"))


@register("u14_quote_plus", """
SELECT seq, replace(url_encode(full_name), '%20', '+') AS encoded FROM user_requests""")
def u14_quote_plus(spark: SparkSession, sf: str) -> DataFrame:
    """quote_plus of search terms (user names here)."""
    return V.user_requests(spark, sf).select("seq", U.quote_plus("full_name").alias("encoded"))


@register("s2_resolve_links", f"""
SELECT link FROM (
  SELECT link, row_number() OVER (PARTITION BY link ORDER BY src_rank, pos) AS rn FROM (
    SELECT 0 AS src_rank, page_id AS pos, trim(url) AS link FROM pages WHERE trim(url) <> ''
    UNION ALL
    SELECT 1, seq, link FROM crawl_docs WHERE NOT EXISTS (SELECT 1 FROM pages WHERE trim(url) <> '')))
WHERE rn = 1""")
def s2_resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    """S1 + S2 + W1: manual links (stored page URLs) win over auto links."""
    from ..sources.tables import read_table
    lines = read_table(spark, sf, "pages", ["page_id", "url"]).select(
        F.col("page_id").alias("pos"), F.col("url").alias("value"))
    manual = L.manual_links(lines)
    auto = V.crawl_docs(spark, sf).select(F.col("seq").alias("pos"), "link")
    return L.resolve_links(manual, auto).select("link")


@register("s3_fallback_links", """
SELECT pos, link FROM (
  SELECT page_id AS pos, trim(CASE WHEN contains(url, '#') THEN '# ' || url ELSE url END) AS link FROM pages)
WHERE link <> '' AND NOT starts_with(link, '#') AND regexp_matches(link, '^[Hh][Tt][Tt][Pp][Ss]?://[^/?#]')
ORDER BY pos LIMIT 25""")
def s3_fallback_links(spark: SparkSession, sf: str) -> DataFrame:
    """S3: fallback link file (stored URLs; fragment URLs written as comments):
    stripped, comments and non-http dropped, cut to the target."""
    return L.fallback_links(V.fallback_lines(spark, sf), L.discovery_target()).select("pos", "link")
