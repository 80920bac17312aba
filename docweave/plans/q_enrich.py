"""Per-document enrichment and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import dictionaries as D
from ..functions import text as T
from ..operators import documents as P
from ..operators import enrich as E
from ..sources import views as V
from ..sources.tables import read_table
from .oracle_enrich import WS, enrich_ctes, q, strip, topic_kw
from .oracle_urls import host, path
from .registry import joined, register

_OUT_SQL = f"""SELECT seq, status, collection_name, source_domain, content_kind, is_ai_related,
  ai_relevance_score, array_to_string(ai_topics, '|') AS ai_topics, array_to_string(ai_keywords, '|') AS ai_keywords,
  has_job_signal, array_to_string(job_roles, '|') AS job_roles, hiring_signal_score,
  array_to_string(tags, '|') AS tags,
  CASE WHEN s = '' THEN NULL WHEN length(s) <= {D.MAX_SUMMARY_CHARS} THEN s
       ELSE regexp_replace(substr(s, 1, {D.MAX_SUMMARY_CHARS}), '{WS}+$', '') || '...' END AS summary,
  md5(content) AS content_md5
FROM (SELECT *, regexp_replace({strip('content')}, '{WS}+', ' ', 'g') AS s FROM enriched)"""


def _doc_out(df: DataFrame) -> DataFrame:
    return df.select(
        "seq", "status", "collection_name", "source_domain", "content_kind", "is_ai_related",
        "ai_relevance_score", joined("ai_topics").alias("ai_topics"), joined("ai_keywords").alias("ai_keywords"),
        "has_job_signal", joined("job_roles").alias("job_roles"), "hiring_signal_score",
        joined("tags").alias("tags"), "summary", F.md5("content").alias("content_md5"))


@register("e11_enrich_documents", _OUT_SQL, enrich_ctes("crawl_docs"))
def e11_enrich_documents(spark: SparkSession, sf: str) -> DataFrame:
    """E11 (E1-E3, E5-E10, E12, E14, E15, U3-U5, P2) per document, default dictionaries."""
    g = P.content_gate(V.crawl_docs(spark, sf))
    return _doc_out(E.enrich(g, D.DEFAULT, topic=V.TOPIC))


@register("e11_enrich_test_vocabulary", _OUT_SQL, enrich_ctes("crawl_docs", D.TEST_VOCABULARY))
def e11_enrich_test_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """E11 with a vocabulary that occurs in the prose: every topic, kind,
    job and category branch is reached."""
    g = P.content_gate(V.crawl_docs(spark, sf))
    return _doc_out(E.enrich(g, D.TEST_VOCABULARY, topic=V.TOPIC))


_TITLE_TOPIC = "SELECT seq, link, title, content, title AS topic_query FROM crawl_docs"


@register("e6_relevance_title_topic", """
SELECT seq, ai_relevance_score, is_ai_related, array_to_string(ai_keywords, '|') AS ai_keywords,
  array_to_string(tags, '|') AS tags FROM enriched""",
          {"titled": _TITLE_TOPIC, **enrich_ctes("titled")})
def e6_relevance_title_topic(spark: SparkSession, sf: str) -> DataFrame:
    """E4-E7, E14, E15 with a per-row topic (the title): keywords expanded per row."""
    d = V.crawl_docs(spark, sf).withColumn("topic_query", F.col("title"))
    e = E.enrich(P.content_gate(d), D.DEFAULT, topic=None)
    return e.select("seq", "ai_relevance_score", "is_ai_related", joined("ai_keywords").alias("ai_keywords"),
                    joined("tags").alias("tags"))


@register("e4_topic_keywords", f"""
SELECT seq, array_to_string({topic_kw('title')}, '|') AS keywords FROM crawl_docs""")
def e4_topic_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword expansion of a topic text (each document's title)."""
    d = V.crawl_docs(spark, sf)
    return d.select("seq", joined(E.topic_keywords("title")).alias("keywords"))


def _in(e: str, words) -> str:
    return f"{e} IN ({', '.join(q(w) for w in words)})"


def _any(e: str, words) -> str:
    return "(" + " OR ".join(f"contains({e}, {q(w)})" for w in words) + ")"


_H, _P = host("link"), f"lower({path('link')})"


@register("e13_provisional_category", f"""
SELECT seq, CASE WHEN {_in(_H, D.CODE_HOSTS)} THEN 'github'
  WHEN {_in(_H, D.RESEARCH_DOMAINS)} OR {_any(_P, D.RESEARCH_PATH_TOKENS)} THEN 'research_papers'
  WHEN {_in(_H, D.JOB_DOMAINS)} OR {_any(_H + ' || ' + _P, D.PROVISIONAL_JOB_URL_TOKENS)} THEN 'job_postings'
  WHEN {_in(_H, D.NEWS_DOMAINS)} OR contains({_H}, 'news') OR starts_with({_P}, '/news') OR contains({_P}, '/news/') THEN 'news'
  WHEN {_in(_H, D.BLOG_DOMAINS)} OR contains({_H}, 'blog') OR starts_with({_P}, '/blog') OR contains({_P}, '/blog/') THEN 'blogs'
  ELSE 'blogs' END AS provisional_category FROM crawl_docs""")
def e13_provisional_category(spark: SparkSession, sf: str) -> DataFrame:
    """URL-only category (news before blogs)."""
    return V.crawl_docs(spark, sf).select("seq", E.provisional_category("link").alias("provisional_category"))


@register("h16_route_extractor", f"""
SELECT seq, CASE {_H} WHEN 'github.com' THEN 'repository' WHEN 'www.github.com' THEN 'repository'
  WHEN 'linkedin.com' THEN 'job' WHEN 'www.linkedin.com' THEN 'job'
  WHEN 'medium.com' THEN 'feed_article' WHEN 'www.medium.com' THEN 'feed_article' ELSE 'article' END AS extractor
FROM crawl_docs""")
def h16_route_extractor(spark: SparkSession, sf: str) -> DataFrame:
    """Extractor chosen by exact host, default article."""
    return V.crawl_docs(spark, sf).select("seq", P.route_extractor("link").alias("extractor"))


@register("e16_flatten_text", """
SELECT conv_id, turn, role || ' ' || text AS from_map, role || ' ' || text AS from_array,
  CAST(turn AS VARCHAR) || ' ' || role || ' ' || text AS from_struct,
  CASE WHEN role = 'user' THEN 'True' ELSE 'False' END || ' ' || text AS from_flag
FROM conversations""")
def e16_flatten_text(spark: SparkSession, sf: str) -> DataFrame:
    """Flatten map / list / record / flag content to text, by static type."""
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"])
    c = c.select("conv_id", "turn", F.create_map(F.lit("role"), "role", F.lit("text"), "text").alias("m"),
                 F.array("role", "text").alias("a"), F.struct("turn", "role", "text").alias("s"),
                 F.struct((F.col("role") == "user").alias("flag"), "text").alias("f"))
    sch = {f.name: f.dataType for f in c.schema.fields}
    return c.select("conv_id", "turn",
                    T.content_to_text("m", sch["m"]).alias("from_map"),
                    T.content_to_text("a", sch["a"]).alias("from_array"),
                    T.content_to_text("s", sch["s"]).alias("from_struct"),
                    T.content_to_text("f", sch["f"]).alias("from_flag"))


@register("u3_u5_text_functions", f"""
SELECT doc_id, md5(n) AS normalized_md5, length(n) AS normalized_chars,
  md5(CASE WHEN length(n) <= {D.MAX_CONTENT_CHARS} THEN n ELSE
      regexp_replace(substr(n, 1, {D.MAX_CONTENT_CHARS - 15}), '{WS}+$', '') || chr(10) || '...[truncated]' END) AS truncated_md5,
  CASE WHEN s = '' THEN NULL WHEN length(s) <= {D.MAX_SUMMARY_CHARS} THEN s
       ELSE regexp_replace(substr(s, 1, {D.MAX_SUMMARY_CHARS}), '{WS}+$', '') || '...' END AS summary,
  nullif(s, '') AS xml_clean_md5_src
FROM (SELECT doc_id, n, regexp_replace({strip('text')}, '{WS}+', ' ', 'g') AS s
      FROM (SELECT doc_id, text, {strip("regexp_replace(text, '" + WS + "*[\\n\\r\\x0B\\f\\x1C\\x1D\\x1E\\x85\\x{2028}\\x{2029}]" + WS + "*', chr(10), 'g')")} AS n
            FROM documents))""".replace("nullif(s, '') AS xml_clean_md5_src", "md5(nullif(s, '')) AS xml_clean_md5"))
def u3_u5_text_functions(spark: SparkSession, sf: str) -> DataFrame:
    """U3 (line normalise), U5 (truncate), U4 (summary), H18 (whitespace clean) on whole texts."""
    d = read_table(spark, sf, "documents", ["doc_id", "text"])
    d = d.withColumn("n", T.normalize_content("text"))
    return d.select("doc_id", F.md5("n").alias("normalized_md5"), F.length("n").cast("bigint").alias("normalized_chars"),
                    F.md5(T.truncate("n")).alias("truncated_md5"), T.summarize("text").alias("summary"),
                    F.md5(T.clean_xml_text("text")).alias("xml_clean_md5"))


_PUB = r"""regexp_extract(html, '(?is)<meta\s[^>]*property\s*=\s*"article:published_time"[^>]*content\s*=\s*"([^"]*)"', 1)"""


@register("u8_local_date", f"""
SELECT doc_id, CASE WHEN {_PUB} = '' THEN NULL ELSE TRY_CAST(substr({_PUB}, 1, 10) AS DATE) END AS published_date
FROM html_docs""")
def u8_local_date(spark: SparkSession, sf: str) -> DataFrame:
    """U7 + U8: publish time parsed, local date taken in the value's own offset."""
    h = V.html_docs(spark, sf)
    raw = F.regexp_extract("html", r'(?is)<meta\s[^>]*property\s*=\s*"article:published_time"[^>]*content\s*=\s*"([^"]*)"', 1)
    return h.select("doc_id", DT.local_date(F.when(raw != "", raw)).alias("published_date"))


@register("p3_challenge_page", r"""
SELECT doc_id, (contains(t, 'performing security verification') OR contains(t, 'enable javascript and cookies to continue')
  OR contains(t, 'this website uses a security service to protect against malicious bots')
  OR contains(t, 'verification successful. waiting for') OR (contains(t, 'ray id') AND contains(t, 'cloudflare'))) AS is_challenge
FROM (SELECT doc_id, lower(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'), '<[^>]*>', ' ', 'g')) AS t
      FROM html_docs)""")
def p3_challenge_page(spark: SparkSession, sf: str) -> DataFrame:
    """Bot-challenge detection on page text (markup removed)."""
    from ..operators.discover import INERT_MARKUP
    h = V.html_docs(spark, sf)
    text = F.regexp_replace(F.regexp_replace("html", INERT_MARKUP, " "), "<[^>]*>", " ")
    return h.select("doc_id", P.is_challenge_page(text).alias("is_challenge"))
