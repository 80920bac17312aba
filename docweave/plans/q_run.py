"""Whole-run queries (X1, X2, H16, A7, S12, S14, S15, U11, U13 + everything a run uses)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents as P
from ..operators import merge as M
from ..operators import route as RT
from ..operators import store as ST
from ..session import work_folder
from ..sources import views as V
from .oracle_enrich import enrich_ctes
from .q_analytics import COLLECTION_CASE
from .registry import joined, register
from .run import crawl, run_batch, summary_json

START, END = dt.date(2024, 1, 10), dt.date(2024, 2, 20)
USER = "Ada Lovelace"

_RUN_CTES = {
    **enrich_ctes("run_docs", seed="seeds", extra_cols="kind, published_date, failure"),
    "res": f"""SELECT seq, link, kind, failure, has_document AS made, title, CASE WHEN ok THEN collection_name END AS collection_name,
  CASE WHEN has_document THEN source_domain END AS source_domain, content_kind, is_ai_related, ai_relevance_score, tags, published_date, ok,
  CASE WHEN failure IS NOT NULL OR NOT has_document THEN 'error' WHEN ok THEN 'ready' ELSE 'filtered_date_range' END AS status,
  CASE WHEN failure IS NOT NULL THEN failure
       WHEN NOT has_document THEN 'insufficient_content: extracted ' || CAST(length(content) AS VARCHAR) || ' chars'
       WHEN published_date < DATE '{START}' THEN 'published_before_start_date'
       WHEN published_date > DATE '{END}' THEN 'published_after_end_date' END AS reason
FROM (SELECT *, has_document AND failure IS NULL AND NOT coalesce(published_date < DATE '{START}' OR published_date > DATE '{END}', false) AS ok FROM enriched)""",
    "cur": f"SELECT link, arg_min(collection_name, {COLLECTION_CASE}) AS existing FROM state GROUP BY link",
    "acts": """SELECT res.*, CASE WHEN status = 'error' THEN 'error' WHEN status <> 'ready' THEN 'skipped' WHEN existing IS NULL THEN 'inserted'
  WHEN existing = collection_name THEN 'duplicate' ELSE 'moved' END AS action FROM res LEFT JOIN cur USING (link)""",
}


def _inputs(views: dict[str, DataFrame]) -> RT.Inputs:
    return RT.Inputs(pages=views["pages"], feeds=views["feeds"], repo_files=views["repo_files"])


@register("x1_routed_documents", """
SELECT seq, status, reason, CASE WHEN made THEN title END AS title, source_domain,
  CASE WHEN made THEN array_to_string(tags, '|') END AS tags, CASE WHEN made THEN published_date END AS published_date,
  CASE WHEN made THEN CASE kind WHEN 'article' THEN 'article' WHEN 'job' THEN 'linkedin' WHEN 'repository' THEN 'github' ELSE 'medium' END END AS made_by,
  CASE WHEN made THEN CASE kind WHEN 'repository' THEN 'readme_only' WHEN 'feed' THEN 'rss' END END AS ingestion_mode
FROM res""", _RUN_CTES)
def x1_routed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """X1, H16, J4 (+H8, H9, H11, H12, H13, L13, S5, S7, P1-P4): every link by its host's extractor, one schema."""
    views = V.run_inputs(spark, sf)
    docs = crawl(views["links"], _inputs(views), V.TOPIC, "u1", USER, START, END)
    made_by = F.when(F.col("platform") == F.col("source_domain"), "article").otherwise(F.col("platform"))
    return docs.select("seq", "status", "reason", "title", "source_domain", joined("tags").alias("tags"), "published_date", made_by.alias("made_by"),
                       F.col("raw_metadata")["ingestion_mode"].alias("ingestion_mode"))


def _store_of_state(spark: SparkSession, sf: str) -> str:
    root = work_folder(spark)
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    ST.create_store(P.as_documents(V.state(spark, sf).withColumns({"id": M.document_id(), "created_at": day, "updated_at": day})), root)
    return root


def _run(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    views = V.run_inputs(spark, sf)
    return run_batch(spark, links=views["links"].withColumnRenamed("seq", "pos"), inputs=_inputs(views), store=_store_of_state(spark, sf),
                     users=V.existing_users(spark, sf), user_full_name=USER, topic_query=V.TOPIC, start_date=START, end_date=END)


_SUMMARY = f"""
SELECT 'agentic ai' AS topic_query, '{USER}' AS user_full_name, DATE '{START}' AS start_date, DATE '{END}' AS end_date,
  count(*) AS discovered, CAST(count_if(action = 'inserted') AS BIGINT) AS saved_count, CAST(count_if(action = 'moved') AS BIGINT) AS moved_count,
  CAST(count_if(action = 'duplicate') AS BIGINT) AS duplicate_count, CAST(count_if(action = 'skipped') AS BIGINT) AS skipped_count,
  CAST(count_if(action = 'error') AS BIGINT) AS error_count, count(DISTINCT coalesce(source_domain, 'unknown')) AS domains,
  (SELECT CAST(coalesce(least(10, sum(least(10, n))), 0) AS BIGINT) FROM (SELECT collection_name, count(*) AS n FROM (
     SELECT DISTINCT collection_name, source_domain, content_kind FROM acts WHERE action IN ('inserted', 'moved') AND is_ai_related) GROUP BY 1)) AS preview_rows,
  (SELECT '{{' || string_agg('"' || collection_name || '":' || CAST(n AS VARCHAR), ',' ORDER BY collection_name) || '}}' FROM (
     SELECT collection_name, count(*) AS n FROM acts WHERE action IN ('inserted', 'moved') GROUP BY 1)) AS per_collection
FROM acts"""


@register("a7_run_summary", _SUMMARY, _RUN_CTES)
def a7_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """A7 (+X2, S12, A1-A4): one run over links of all four platforms, merged into the bucketed store; its summary row."""
    s = _run(spark, sf)["summary"]
    return s.select("topic_query", "user_full_name", "start_date", "end_date",
                    F.col("discovered_count").alias("discovered"),
                    "saved_count", "moved_count", "duplicate_count", "skipped_count", "error_count",
                    F.col("domain_count").alias("domains"), F.size("analytics_preview").cast("bigint").alias("preview_rows"),
                    F.to_json("per_collection").alias("per_collection"))


@register("s14_summary_json", f"""
SELECT '{{"topic_query":"' || topic_query || '","user_full_name":"' || user_full_name || '","start_date":"' || CAST(start_date AS VARCHAR)
  || '","end_date":"' || CAST(end_date AS VARCHAR) || '","discovered_count":' || CAST(discovered AS VARCHAR)
  || ',"saved_count":' || CAST(saved_count AS VARCHAR) || ',"per_collection":' || per_collection || '}}' AS json FROM ({_SUMMARY})""", _RUN_CTES)
def s14_summary_json(spark: SparkSession, sf: str) -> DataFrame:
    """The run record's repeatable fields as canonical JSON (dates as ISO text, map keys in order)."""
    s = _run(spark, sf)["summary"]
    return summary_json(s.select("topic_query", "user_full_name", "start_date", "end_date", "discovered_count", "saved_count", "per_collection"))
