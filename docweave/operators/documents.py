"""Document records and their gates.

A crawl result is one flat row: ``status``, ``reason``, ``has_document``
plus the document's columns (left in place when a gate drops the
document, so the run metrics still see ``source_domain`` and scores).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from ..functions import dictionaries as D
from ..functions import text as T
from ..functions import urls as U
from ..functions.text import col
from . import enrich as E

DOCUMENT_COLUMNS = (
    "collection_name", "title", "content", "summary", "published_at", "published_date", "source",
    "source_domain", "link", "platform", "topic_query", "tags", "content_kind", "is_ai_related",
    "ai_relevance_score", "ai_topics", "ai_keywords", "has_job_signal", "job_roles",
    "hiring_signal_score", "created_by_user_id", "created_by_user_name", "raw_metadata",
)


#: The stored record.
_KINDS = {"string": TY.StringType(), "time": TY.TimestampType(), "date": TY.DateType(), "bool": TY.BooleanType(), "score": TY.DoubleType(),
          "words": TY.ArrayType(TY.StringType()), "map": TY.MapType(TY.StringType(), TY.StringType())}
_RECORD = {
    "id": "string", "link": "string", "collection_name": "string", "title": "string", "content": "string", "summary": "string",
    "published_at": "time", "published_date": "date", "source": "string", "source_domain": "string", "platform": "string",
    "topic_query": "string", "tags": "words", "content_kind": "string", "is_ai_related": "bool", "ai_relevance_score": "score",
    "ai_topics": "words", "ai_keywords": "words", "has_job_signal": "bool", "job_roles": "words", "hiring_signal_score": "score",
    "created_by_user_id": "string", "created_by_user_name": "string", "raw_metadata": "map", "created_at": "time", "updated_at": "time",
}
DOCUMENT_SCHEMA = TY.StructType([TY.StructField(name, _KINDS[kind]) for name, kind in _RECORD.items()])


def as_documents(df: DataFrame) -> DataFrame:
    """The record's columns, those that ``df`` lacks as null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in DOCUMENT_SCHEMA])


def is_challenge_page(text) -> Column:
    """Bot-challenge page (lower-cased text has a phrase, or both pair words)."""
    lc = F.lower(col(text))
    a, b = D.CHALLENGE_PAIR
    return T.contains_any(lc, D.CHALLENGE_PHRASES) | (lc.contains(a) & lc.contains(b))


def content_gate(df: DataFrame, content: str = "content",
                 min_chars: int = D.MIN_CONTENT_CHARS) -> DataFrame:
    """Normalise the content (U3) and fail documents below the minimum."""
    out = df.withColumn(content, T.normalize_content(F.coalesce(F.col(content), F.lit(""))))
    n = F.length(F.col(content))
    short = n < min_chars
    return out.withColumns({
        "status": F.when(short, F.lit("error")).otherwise(F.lit("ready")),
        "reason": F.when(short, F.concat(F.lit("insufficient_content: extracted "), n.cast("string"),
                                         F.lit(" chars"))),
        "has_document": ~short,
    })


def extraction_gate(df: DataFrame, failure: str) -> DataFrame:
    """A row whose extraction failed is an error for that reason, whatever the length of its content."""
    failed = F.col(failure).isNotNull()
    return df.withColumns({
        "status": F.when(failed, F.lit("error")).otherwise(F.col("status")),
        "reason": F.coalesce(failure, "reason"),
        "has_document": F.col("has_document") & ~failed,
    }).drop(failure)


def build_documents(df: DataFrame, dicts: D.Dictionaries = D.DEFAULT, *, topic: str | None = None,
                    user_id: str | None = None, user_name: str | None = None,
                    seed_tags: str | None = None, columns: Collection[str] | None = None, failure: str | None = None) -> DataFrame:
    """P1 + P2 + E11 on extracted parts (link, title, content, topic_query ...).

    ``columns``: the enriched columns the caller needs (default: all).  ``failure``: a column with the error
    of a failed extraction (P3), null where there is none.

    Errors keep their link and reason; their document columns are null and
    their metrics empty (they count under ``unknown`` in A2).
    """
    gated = content_gate(df)
    if failure is not None:
        gated = extraction_gate(gated, failure)
    enriched = E.enrich(gated, dicts, topic=topic, seed_tags=seed_tags, columns=columns)
    ok = F.col("has_document")
    keep = {c: F.when(ok, F.col(c)) for c in enriched.columns
            if c in DOCUMENT_COLUMNS and c not in ("link", "topic_query")}
    out = enriched.withColumns(keep)
    if user_id is not None:
        out = out.withColumn("created_by_user_id", F.lit(user_id))
    if user_name is not None:
        out = out.withColumn("created_by_user_name", F.lit(user_name))
    return out


def apply_date_filter(df: DataFrame, start: _dt.date | None, end: _dt.date | None,
                      date_col: str = "published_date") -> DataFrame:
    """Inclusive window on the local publish date; a missing date is kept.

    A filtered row keeps status/reason/metrics but loses its document.
    """
    d = F.col(date_col)
    has = F.col("has_document")
    before = has & d.isNotNull() & (F.lit(start).cast("date") > d) if start else F.lit(False)
    after = has & d.isNotNull() & (d > F.lit(end).cast("date")) if end else F.lit(False)
    return df.withColumns({
        "status": F.when(before | after, F.lit("filtered_date_range")).otherwise(F.col("status")),
        "reason": (F.when(before, F.lit("published_before_start_date"))
                   .when(after, F.lit("published_after_end_date")).otherwise(F.col("reason"))),
        "has_document": has & ~before & ~after,
    })


def load_outcome(status="status", has_document="has_document") -> Column:
    """Error / skipped / candidate."""
    s = col(status)
    return (F.when(s == "error", F.lit("error"))
            .when(s.isin("filtered_non_ai", "filtered_date_range") | ~col(has_document), F.lit("skipped"))
            .otherwise(F.lit("candidate")))


def topic_match(df: DataFrame, topic_query: str | None) -> DataFrame:
    """AI-related documents, of one topic when a topic is given."""
    cond = F.col("is_ai_related")
    if topic_query:
        cond = cond & (F.col("topic_query") == topic_query)
    return df.filter(cond)


def key_projection(df: DataFrame) -> DataFrame:
    """Only the lookup key survives (Catalyst prunes the scan)."""
    return df.select("collection_name", "link")


def route_extractor(link, hosts: tuple[tuple[str, str], ...] = D.EXTRACTOR_HOSTS) -> Column:
    """Extractor kind by exact host, default article."""
    h = U.host(link)
    out = F.lit("article")
    for hst, kind in reversed(hosts):
        out = F.when(h == hst, F.lit(kind)).otherwise(out)
    return out
