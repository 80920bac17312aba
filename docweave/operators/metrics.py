"""Run metrics and topic analytics.

All aggregations are hash aggregates with a partial (map-side) phase, so a
host or group holding a third of all rows costs one partial row per task,
not a third of the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from .documents import topic_match

GROUP_KEYS = ("collection_name", "source_domain", "content_kind")


def collection_rank(c="collection_name") -> Column:
    """Position of a collection in the store's fixed order."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(len(D.COLLECTION_ORDER))
    for i, name in reversed(list(enumerate(D.COLLECTION_ORDER))):
        out = F.when(c == name, F.lit(i)).otherwise(out)
    return out


def topic_groups(docs: DataFrame, topic_query: str | None = D.DEFAULT_TOPIC_QUERY) -> DataFrame:
    """A1 (+P14): per (collection, domain, kind) counts and averages of the matching documents.

    The groups' topic and tag lists are rows of :func:`group_terms`, not arrays."""
    return topic_match(docs, topic_query).groupBy(*GROUP_KEYS).agg(
        F.count(F.lit(1)).alias("document_count"),
        F.avg("ai_relevance_score").alias("avg_ai_relevance_score"),
        F.avg("hiring_signal_score").alias("avg_hiring_signal_score"))


def group_terms(docs: DataFrame, groups: DataFrame, topic_query: str | None = D.DEFAULT_TOPIC_QUERY) -> DataFrame:
    """A1's term lists in long form: every topic and tag of the given groups with its
    number of documents.  One row per (group, term kind, term), however many terms
    a group has; counting is partial per task, so a hot group costs little."""
    matched = topic_match(docs, topic_query).join(groups.select(*GROUP_KEYS), list(GROUP_KEYS), "left_semi")

    def named(column: str, kind: str) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")),
                           lambda t: F.struct(F.lit(kind).alias("term_kind"), t.alias("term")))

    terms = matched.select(*GROUP_KEYS, F.inline(F.concat(named("ai_topics", "topic"), named("tags", "tag"))))
    return terms.groupBy(*GROUP_KEYS, "term_kind", "term").agg(F.count(F.lit(1)).alias("documents"))


def top_per_collection(groups: DataFrame, k: int = D.MAX_ANALYTICS_RESULTS) -> DataFrame:
    """Top k groups per collection by count desc, average relevance desc.

    Ties the source leaves open are broken by (domain, kind).  The average
    is compared at 10 decimals so float summation order cannot reorder
    equal groups.  ``row_number() <= k`` plans as a WindowGroupLimit, which
    cuts each partition to k rows before the shuffle.
    """
    w = Window.partitionBy("collection_name").orderBy(
        F.desc("document_count"), F.desc(F.round("avg_ai_relevance_score", 10)),
        F.asc("source_domain"), F.asc("content_kind"))
    return groups.withColumn("rank_in_collection", F.row_number().over(w)).filter(
        F.col("rank_in_collection") <= k)


def global_top(per_collection: DataFrame, k: int = D.MAX_ANALYTICS_RESULTS) -> DataFrame:
    """The union of the per-collection lists, count desc, stable.

    Equal counts keep the collection order, then the order within the
    collection.  ``orderBy().limit()`` plans as TakeOrderedAndProject.
    """
    return (per_collection.withColumn("collection_rank", collection_rank())
            .orderBy(F.desc("document_count"), F.asc("collection_rank"), F.asc("rank_in_collection"))
            .limit(k))


def topic_analytics(docs: DataFrame, topic_query: str | None = D.DEFAULT_TOPIC_QUERY,
                    k: int = D.MAX_ANALYTICS_RESULTS) -> DataFrame:
    """A1 -> W5 -> W6 (M3: one partitioned table replaces the five-way union)."""
    return global_top(top_per_collection(topic_groups(docs, topic_query), k), k)


def domain_metrics(results: DataFrame) -> DataFrame:
    """A2: per-domain totals of a run's crawl results.

    Rows without metadata count under ``unknown``; the average divides the
    summed relevance (missing = 0) by all rows of the domain, 4 decimals.
    """
    dom = F.coalesce(F.col("source_domain"), F.lit("unknown"))
    st = F.col("status")
    return results.groupBy(dom.alias("source_domain")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(st == "ready").alias("saved"),
        F.count_if(st == "filtered_non_ai").alias("filtered_non_ai"),
        F.count_if(st == "error").alias("errors"),
        F.round(F.sum(F.coalesce(F.col("ai_relevance_score"), F.lit(0.0))) / F.count(F.lit(1)), 4)
        .alias("avg_ai_relevance_score"),
    )


def load_counters(actions: DataFrame) -> DataFrame:
    """A3: one row of load counters from the per-row ``action`` column (M1)."""
    a = F.col("action")
    return actions.agg(
        F.count_if(a == "inserted").alias("saved_count"),
        F.count_if(a == "moved").alias("moved_count"),
        F.count_if(a == "duplicate").alias("duplicate_count"),
        F.count_if(a == "skipped").alias("skipped_count"),
        F.count_if(a == "error").alias("error_count"),
    )


def per_collection_counts(actions: DataFrame) -> DataFrame:
    """A4: inserted + moved per target collection."""
    return (actions.filter(F.col("action").isin("inserted", "moved"))
            .groupBy("collection_name").agg(F.count(F.lit(1)).alias("documents")))


def per_collection_map(actions: DataFrame) -> DataFrame:
    """A4 as the run record's map column (one row)."""
    counts = per_collection_counts(actions)
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("collection_name", "documents")))).alias("per_collection"))
