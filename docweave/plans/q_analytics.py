"""Flagship and analytics queries (E11 -> P14 -> A1 -> W5 -> W6, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..operators import documents as P
from ..operators import metrics as A
from ..sources import views as V
from .oracle_enrich import enrich_ctes
from .registry import register

COLLECTION_CASE = ("CASE collection_name WHEN 'blogs' THEN 0 WHEN 'news' THEN 1 WHEN 'github' THEN 2 "
                   "WHEN 'research_papers' THEN 3 WHEN 'job_postings' THEN 4 ELSE 5 END")


#: What the groups of A1 are made of.
GROUP_COLUMNS = (*A.GROUP_KEYS, "is_ai_related", "ai_relevance_score", "hiring_signal_score")


def enriched_docs(spark: SparkSession, data_dir: str, dicts: D.Dictionaries = D.DEFAULT, columns=None) -> DataFrame:
    """crawl_docs -> U3 + P2 gate -> E11 (one map-only stage), of E11 the named columns."""
    return P.build_documents(V.crawl_docs(spark, data_dir), dicts, topic=V.TOPIC, columns=columns)


def _analytics_out(df: DataFrame) -> DataFrame:
    return df.select(
        "collection_name", "source_domain", "content_kind",
        F.col("document_count").cast("bigint").alias("document_count"),
        F.round("avg_ai_relevance_score", 8).alias("avg_ai_relevance_score"),
        F.round("avg_hiring_signal_score", 8).alias("avg_hiring_signal_score"),
        F.col("rank_in_collection").cast("bigint").alias("rank_in_collection"),
    )


def _groups_sql(src: str) -> dict[str, str]:
    return {
        "grp": f"""SELECT collection_name, source_domain, content_kind, count(*) AS document_count,
  avg(ai_relevance_score) AS a1, avg(hiring_signal_score) AS a2 FROM {src} GROUP BY ALL""",
        "ranked": """SELECT *, row_number() OVER (PARTITION BY collection_name
  ORDER BY document_count DESC, round(a1, 10) DESC, source_domain, content_kind) AS rn FROM grp""",
        "top": f"""SELECT * FROM ranked WHERE rn <= 10 ORDER BY document_count DESC, {COLLECTION_CASE}, rn LIMIT 10""",
    }


_ANALYTICS_SELECT = """SELECT collection_name, source_domain, content_kind, document_count,
  round(a1, 8) AS avg_ai_relevance_score, round(a2, 8) AS avg_hiring_signal_score, rn AS rank_in_collection
FROM top"""

_FLAGSHIP_CTES = {
    **enrich_ctes("crawl_docs"),
    "matched": "SELECT * FROM enriched WHERE has_document AND is_ai_related AND topic_query = 'agentic ai'",
    **_groups_sql("matched"),
}


@register("w6_topic_top10", _ANALYTICS_SELECT, _FLAGSHIP_CTES)
def topic_top10(spark: SparkSession, data_dir: str) -> DataFrame:
    """Flagship. crawl_docs -> U3, P2 -> E1-E12, E14 (E11) -> P14 -> A1 -> W5 -> W6.

    Top (collection, domain, kind) groups of topic-related documents.  Covers M3 (one
    table instead of a five-way union) and A5/A6 (arg-max and distinct counts inside E9/E6).
    """
    return _analytics_out(A.topic_analytics(enriched_docs(spark, data_dir, columns=GROUP_COLUMNS), D.DEFAULT_TOPIC_QUERY))


_TERMS = """SELECT collection_name, source_domain, content_kind, kind AS term_kind, term, count(*) AS documents FROM (
  SELECT collection_name, source_domain, content_kind, 'topic' AS kind, unnest(ai_topics) AS term FROM matched
  UNION ALL SELECT collection_name, source_domain, content_kind, 'tag' AS kind, unnest(tags) AS term FROM matched) {where}
GROUP BY ALL"""


@register("a1_group_terms", _TERMS.format(where=""), _FLAGSHIP_CTES)
def a1_group_terms(spark: SparkSession, data_dir: str) -> DataFrame:
    """A1's topic and tag lists of every group, all terms, as long rows."""
    docs = enriched_docs(spark, data_dir, columns=(*GROUP_COLUMNS, "ai_topics", "tags"))
    groups = A.topic_groups(docs)
    return A.group_terms(docs, groups)


@register("w6_top10_terms", _TERMS.format(
    where="SEMI JOIN top USING (collection_name, source_domain, content_kind)"), _FLAGSHIP_CTES)
def w6_top10_terms(spark: SparkSession, data_dir: str) -> DataFrame:
    """A1's topic and tag lists of the ten groups that W6 reports."""
    docs = enriched_docs(spark, data_dir, columns=(*GROUP_COLUMNS, "ai_topics", "tags"))
    return A.group_terms(docs, A.topic_analytics(docs))
