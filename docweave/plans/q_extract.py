"""Page extraction queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as P
from ..operators import extract as X
from ..sources import views as V
from ..sources.pages import page_text
from ..sources.tables import read_table
from .oracle_enrich import enrich_ctes, norm_content, q, strip
from .oracle_urls import INERT, unescape
from .registry import joined, register

_H = f"regexp_replace(html, {q(INERT)}, ' ', 'g')"


def _elem_text(h: str, tag: str) -> str:
    inner = f"regexp_extract({h}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1)"
    return (f"array_to_string(list_filter(list_transform(regexp_split_to_array({inner}, '<[^>]*>'), "
            f"lambda x: {strip(unescape('x'))}), lambda x: x <> ''), ' ')")


def _meta(h: str, attr: str, value: str) -> str:
    tag = f"""regexp_extract({h}, '(?is)<meta\\b[^>]*\\s{attr}\\s*=\\s*(?:"{value}"[^>]*|''{value}''[^>]*|{value}(?:[\\s/][^>]*)?)>', 0)"""
    pat = q(r"""(?is)\scontent\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
    content = f"(regexp_extract({tag}, {pat}, 1) || regexp_extract({tag}, {pat}, 2) || regexp_extract({tag}, {pat}, 3))"
    return f"CASE WHEN {tag} <> '' AND {content} <> '' THEN {strip(unescape(content))} END"


@register("h1_h5_page_fields", f"""
SELECT doc_id, CASE WHEN og IS NOT NULL THEN og WHEN t <> '' THEN t WHEN h1 <> '' THEN h1 END AS html_title,
  description, array_to_string(list_filter(list_transform(string_split(coalesce(kw, ''), ','),
     lambda x: lower({strip('x')})), lambda x: x <> ''), '|') AS tags,
  published_date
FROM (SELECT doc_id, {_meta('h', 'property', 'og:title')} AS og, {_elem_text('h', 'title')} AS t,
        {_elem_text('h', 'h1')} AS h1,
        -- The references as HTML 5 reads them, by construction of the page.
        'D' || CAST(doc_id AS VARCHAR) || ' ©2 €¬it; &lt; 𝔹A � &nosuch; &' AS description,
        {_meta('h', 'name', 'keywords')} AS kw,
        TRY_CAST(substr({_meta('h', 'property', 'article:published_time')}, 1, 10) AS DATE) AS published_date
      FROM (SELECT doc_id, {_H} AS h FROM html_docs))""")
def h1_h5_page_fields(spark: SparkSession, sf: str) -> DataFrame:
    """H1 (title), H2 (description), H4 (keyword tags), H5 + U7 + U8 (publish date)."""
    f = X.page_fields(V.html_docs(spark, sf))
    return f.select("doc_id", "html_title", "description", joined("tags").alias("tags"), "published_date")


_NATIVE_TEXT = norm_content(unescape(
    f"regexp_replace(regexp_replace(html, {q(INERT)}, chr(10), 'g'), '<[^>]*>', chr(10), 'g')"))


@register("h3_native_text", f"SELECT page_id, md5({_NATIVE_TEXT}) AS text_md5 FROM pages")
def h3_native_text(spark: SparkSession, sf: str) -> DataFrame:
    """H3 native form: page text with markup, scripts, styles and comments removed."""
    p = read_table(spark, sf, "pages", ["page_id", "html"])
    return p.select("page_id", F.md5(X.native_text(F.col("html"))).alias("text_md5"))


@register("s4_stored_pages", "SELECT page_id, md5(html || chr(65533) || chr(65533) || 'x') AS text_md5 FROM pages WHERE html IS NOT NULL")
def s4_stored_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages stored as bytes, read as UTF-8 with replacement; pages that cannot be read are skipped."""
    p = read_table(spark, sf, "pages", ["page_id", "html"])
    stored = p.select("page_id", F.concat(F.encode("html", "UTF-8"), F.unhex(F.lit("FFC378"))).alias("content"))
    return stored.select("page_id", page_text("content").alias("html")).filter("html IS NOT NULL").select("page_id", F.md5("html").alias("text_md5"))


_PLAIN = f"regexp_replace(html, {q(INERT)}, chr(10), 'g')"


def _text_lines(e: str) -> str:
    return norm_content(unescape(f"regexp_replace({e}, '<[^>]*>', chr(10), 'g')"))


_REGION = "CASE " + " ".join(
    f"WHEN regexp_matches(p, {q(x)}) THEN regexp_extract(p, {q(x)}, 1)" for x in (
        r"(?is)<article\b[^>]*>(.*?)</article\s*>", r"(?is)<main\b[^>]*>(.*?)</main\s*>",
        r"""(?is)<div\b[^>]*\srole\s*=\s*["']?main\b["']?[^>]*>(.*?)</div\s*>""", r"(?is)<body\b[^>]*>(.*)")) + " ELSE p END"


@register("h3_main_text", f"""
SELECT page_id, md5({_text_lines('region')}) AS text_md5 FROM (SELECT page_id, {_REGION} AS region FROM (SELECT page_id, {_PLAIN} AS p FROM pages))""")
def h3_main_text(spark: SparkSession, sf: str) -> DataFrame:
    """H3: text of the first article, main, role=main block or body of each stored page."""
    p = read_table(spark, sf, "pages", ["page_id", "html"])
    return p.select("page_id", F.md5(X.main_text(F.col("html"))).alias("text_md5"))


def _document_rows(records: DataFrame, key: str, failure: str | None = None) -> DataFrame:
    docs = P.build_documents(records.withColumns({"seq": F.col(key), "topic_query": F.lit(V.TOPIC)}), topic=V.TOPIC, seed_tags="tags", failure=failure)
    return docs


_ART = f"""SELECT seq, link, title, {_text_lines('region')} AS content, 'agentic ai' AS topic_query
FROM (SELECT page_id AS seq, url AS link, coalesce(CASE WHEN t <> '' THEN t END, url) AS title, {_REGION} AS region
      FROM (SELECT page_id, url, {_elem_text(_H, 'title')} AS t, {_PLAIN} AS p FROM pages))"""
_ENRICHED = """SELECT seq, status, title, collection_name, content_kind, ai_relevance_score,
  array_to_string(tags, '|') AS tags FROM enriched WHERE has_document
UNION ALL SELECT seq, status, NULL, NULL, NULL, NULL, NULL FROM enriched WHERE NOT has_document"""


def _enriched_out(docs: DataFrame) -> DataFrame:
    return docs.select("seq", "status", "title", "collection_name", "content_kind", "ai_relevance_score", joined("tags").alias("tags"))


@register("h9_article_documents", _ENRICHED, {"art": _ART, **enrich_ctes("art")})
def h9_article_documents(spark: SparkSession, sf: str) -> DataFrame:
    """H9 (+H1, H3, P1, P2, P3, E11): stored pages -> article documents.

    A bot-challenge page is an error without a document; the SQL states P2 only, as the given tables hold no such page."""
    p = read_table(spark, sf, "pages", ["page_id", "url", "html"]).withColumnRenamed("url", "link")
    return _enriched_out(_document_rows(X.article_records(p), "page_id", "challenge_reason"))


@register("h6_job_fields", """
SELECT seq, title, company, location, criteria, md5(about) AS about_md5 FROM job_docs""")
def h6_job_fields(spark: SparkSession, sf: str) -> DataFrame:
    """H6, H7: title, company, location, criteria and description of job pages."""
    j = X.without_inert(V.job_docs(spark, sf).select("seq", "html"))
    h = F.col("_plain")
    return j.select("seq", X.first_text(h, X.JOB_TITLE).alias("title"), X.first_text(h, X.JOB_COMPANY).alias("company"),
                    X.first_text(h, X.JOB_LOCATION).alias("location"), X.joined_text(h, X.JOB_CRITERIA).alias("criteria"),
                    F.md5(X.first_text(h, X.JOB_DESCRIPTION)).alias("about_md5"))


_JOBS = """SELECT seq, link, title, 'Job title: ' || title || chr(10) || 'Company: ' || company || chr(10) || 'Location: ' || location
  || chr(10) || criteria || chr(10) || about AS content, 'agentic ai' AS topic_query FROM job_docs"""


@register("h8_job_documents", """
SELECT seq, status, title, 'linkedin' AS platform, collection_name, content_kind, has_job_signal FROM enriched WHERE has_document
UNION ALL SELECT seq, status, NULL, NULL, NULL, NULL, NULL FROM enriched WHERE NOT has_document""", {"jobs": _JOBS, **enrich_ctes("jobs")})
def h8_job_documents(spark: SparkSession, sf: str) -> DataFrame:
    """H8 (+H6, H7, P2, E11): job pages -> job documents (labelled lines)."""
    docs = _document_rows(X.job_records(V.job_docs(spark, sf).select("seq", "link", "html")), "seq")
    return docs.select("seq", "status", "title", "platform", "collection_name", "content_kind", "has_job_signal")


_RENDERED = f"""SELECT page_id AS seq, url AS link,
  coalesce(CASE WHEN h1 <> '' THEN h1 END, CASE WHEN t <> '' THEN t END, url) AS title, {_NATIVE_TEXT} AS content, 'agentic ai' AS topic_query
FROM (SELECT *, {_elem_text(_H, 'h1')} AS h1, {_elem_text(_H, 'title')} AS t FROM pages)"""


@register("h12_rendered_article_documents", _ENRICHED, {"rendered": _RENDERED, **enrich_ctes("rendered")})
def h12_rendered_article_documents(spark: SparkSession, sf: str) -> DataFrame:
    """H12 (+H5, H4, P2, P3, E11): rendered pages stored for feed hosts -> documents."""
    p = read_table(spark, sf, "pages", ["page_id", "url", "html"]).withColumnRenamed("url", "link")
    return _enriched_out(_document_rows(X.rendered_article_records(p), "page_id"))


@register("h14_repository_pages", """
SELECT seq, md5(about) AS readme_md5, 'llm|' || lower(company) AS topics FROM job_docs""")
def h14_repository_pages(spark: SparkSession, sf: str) -> DataFrame:
    """README block and topic tags of repository pages."""
    j = V.job_docs(spark, sf)
    page = j.select("seq", F.concat(F.lit('<html><a class="topic-tag topic-tag-link">LLM</a><a class="topic-tag"> '), F.col("company"),
                                    F.lit('</a><a class="topic-tag">llm</a><article class="markdown-body entry"><article></article><p>'), F.col("about"),
                                    F.lit("</p></article><p>Footer</p></html>")).alias("html"))
    return X.repository_page_fields(page).select("seq", F.md5("readme").alias("readme_md5"), joined("topics").alias("topics"))
