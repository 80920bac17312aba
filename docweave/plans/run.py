"""One ETL run as Spark jobs.

links: manual, else discovered, else fallback (S2, L12, S3) -> documents by each link's
extractor (H16: articles, jobs, feed entries, repositories; P2, P3, E11) -> date
window (P4) -> outcome (P12) -> merge into the bucketed store (M1, M2, S12) -> counters
(A3, A4), domain metrics (A2), topic analytics on the new store (A1, W5,
W6) -> one run-summary row (A7).

Crawl results feed five outputs; they are written once to the shared work
folder, which cuts the lineage (an executor lost later reads that table, not
the pages) and avoids recomputing the enrichment per output.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from ..functions import dates as DT
from ..functions import dictionaries as D
from ..operators import discover as L
from ..operators import documents as P
from ..operators import merge as M
from ..operators import metrics as A
from ..operators import route as RT
from ..operators import store as ST
from ..session import saved

ANALYTICS_PIPELINE = [
    "match: is_ai_related AND topic_query = :topic",
    "group: collection_name, source_domain, content_kind -> document_count, avg_ai_relevance_score, "
    "avg_hiring_signal_score; all topics and tags as long rows",
    "sort: document_count desc, avg_ai_relevance_score desc (per collection)",
    "limit: 10 per collection, then 10 overall (count desc, collection order)",
]


def crawl(links: DataFrame, inputs: RT.Inputs, topic: str, user_id: str, user_name: str, start: dt.date | None, end: dt.date | None,
          dicts: D.Dictionaries = D.DEFAULT, extractors: RT.Extractors = RT.Extractors()) -> DataFrame:
    """links (seq, link) + stored inputs -> crawl results, each link by its host's extractor.

    A link without a stored page (or README) is an error row, as a failed fetch is."""
    parts = RT.extract_links(links, inputs, extractors).withColumns({
        "topic_query": F.lit(topic), "tags": F.coalesce("tags", F.array().cast("array<string>"))})
    docs = P.build_documents(parts, dicts, topic=topic, user_id=user_id, user_name=user_name, seed_tags="tags")
    failed = F.col("failure").isNotNull()
    docs = docs.withColumns({
        "status": F.when(failed, F.lit("error")).otherwise(F.col("status")),
        "reason": F.coalesce("failure", "reason"),
        "has_document": F.col("has_document") & ~failed,
    }).drop("failure")
    return P.apply_date_filter(docs, start, end)


def run_batch(spark: SparkSession, *, inputs: RT.Inputs, store: str, users: DataFrame, links: DataFrame | None = None,
              registry: DataFrame | None = None, fallback: DataFrame | None = None, max_links: int | None = D.MAX_LINKS,
              user_full_name: str = D.DEFAULT_USER_FULL_NAME, topic_query: str = D.DEFAULT_TOPIC_QUERY,
              start_date: dt.date | None = None, end_date: dt.date | None = None, runs_out: str | None = None,
              dicts: D.Dictionaries = D.DEFAULT, extractors: RT.Extractors = RT.Extractors()) -> dict[str, DataFrame]:
    """The whole run against the store in folder ``store`` (see ``operators/store.py``).

    ``links`` (pos, link) are manual links; without any, links are discovered from the ``registry``'s
    listing pages, and without those taken from the ``fallback`` lines (S2, S3, L12).  Returns the run's
    DataFrames (summary, links, results, actions, users, domains, terms); with ``runs_out`` the
    summary (S14) and what grows with the run are appended there."""
    if isinstance(start_date, str):
        start_date = DT.parse_cli_date(start_date)
    if isinstance(end_date, str):
        end_date = DT.parse_cli_date(end_date)
    if start_date is None and end_date is None:
        start_date, end_date = DT.default_window()
    DT.check_window(start_date, end_date)
    started = dt.datetime.now(dt.timezone.utc)
    topic = topic_query.strip() or D.DEFAULT_TOPIC_QUERY

    requested = spark.createDataFrame([(user_full_name,)], "full_name string")
    new_users = M.resolve_users(requested, users)
    user = (users.unionByName(new_users, allowMissingColumns=True)
            .filter(F.col("full_name") == user_full_name).select("id", "full_name").limit(1).first())
    user_id = user["id"] if user and user["id"] is not None else str(uuid.uuid4())

    chosen = saved(L.run_links(spark, links, registry, inputs.pages, inputs.feeds, fallback, max_links))
    results = saved(crawl(chosen, inputs, topic, user_id, user_full_name, start_date, end_date, dicts, extractors)
                    .withColumn("outcome", P.load_outcome()))
    _, actions = ST.merge_batch(spark, store, P.DOCUMENT_SCHEMA, results, outcome="outcome", now=F.lit(started).cast("timestamp"))
    new_state = ST.read_store(spark, store, P.DOCUMENT_SCHEMA)

    summary = saved(run_summary(spark, results, actions, new_state, chosen, topic, user_id,
                                user_full_name, start_date, end_date, started))
    run_id = summary.first()["run_id"]
    # What grows with a run is kept as child tables under the run's id, not as arrays of its row.
    children = {
        "links": chosen.select(F.lit(run_id).alias("run_id"), "seq", "link"),
        "domains": A.domain_metrics(results).select(F.lit(run_id).alias("run_id"), "*"),
        "terms": A.group_terms(new_state, A.topic_analytics(new_state, topic), topic)
        .select(F.lit(run_id).alias("run_id"), "*"),
    }
    if runs_out:
        summary.write.mode("append").parquet(f"{runs_out}/runs")
        for name, child in children.items():
            child.write.mode("append").parquet(f"{runs_out}/{name}")
    return {"summary": summary, "results": results, "actions": actions, "new_state": new_state,
            "users": new_users, **children}


def run_summary(spark: SparkSession, results: DataFrame, actions: DataFrame, new_state: DataFrame,
                links: DataFrame, topic: str, user_id: str, user_name: str,
                start: dt.date | None, end: dt.date | None, started: dt.datetime) -> DataFrame:
    """One summary row assembled from one-row aggregates.

    Each part is a one-row aggregate tagged with its own columns; a union
    and a single ``first(ignorenulls)`` aggregate put them side by side
    (no cross join).
    """
    counters = A.load_counters(actions)
    per_coll = A.per_collection_map(actions)
    domains = A.domain_metrics(results).agg(F.count(F.lit(1)).alias("domain_count"))
    preview = A.topic_analytics(new_state, topic).agg(F.collect_list(F.struct(
        "collection_name", "source_domain", "content_kind", "document_count", "avg_ai_relevance_score",
        "avg_hiring_signal_score")).alias("analytics_preview"))
    discovered = links.agg(F.count(F.lit(1)).alias("discovered_count"))
    parts = [counters, per_coll, domains, preview, discovered]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    cols = [c for p in parts for c in p.columns]
    row = merged.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
    today = dt.date.today()
    return row.select(
        F.expr("uuid()").alias("run_id"), F.lit(topic).alias("topic_query"), F.lit(user_id).alias("user_id"),
        F.lit(user_name).alias("user_full_name"), F.lit(start or today).alias("start_date"),
        F.lit(end or today).alias("end_date"), "discovered_count",
        F.lit(started).alias("started_at"), F.current_timestamp().alias("finished_at"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in counters.columns],
        "per_collection", "domain_count",
        F.array(*[F.lit(s) for s in ANALYTICS_PIPELINE]).alias("analytics_pipeline"),
        "analytics_preview")


def canonical(c: Column, kind: TY.DataType) -> Column:
    """A value in the form that is written as JSON: dates and times as ISO text, map keys in order, lists
    and structs element by element, by the column's static type."""
    if isinstance(kind, TY.TimestampType):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    if isinstance(kind, TY.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, TY.ArrayType):
        return F.transform(c, lambda x: canonical(x, kind.elementType))
    if isinstance(kind, TY.MapType):
        entries = F.transform(F.array_sort(F.map_keys(c)), lambda k: F.struct(k.alias("key"), canonical(c[k], kind.valueType).alias("value")))
        return F.map_from_entries(entries)
    if isinstance(kind, TY.StructType):
        return F.when(c.isNotNull(), F.struct(*[canonical(c[f.name], f.dataType).alias(f.name) for f in kind]))
    return c


def summary_json(summary: DataFrame, pretty: bool = False) -> DataFrame:
    """The run record as canonical JSON text (one row): all fields, nulls too."""
    opts = {"ignoreNullFields": "false"} | ({"pretty": "true"} if pretty else {})
    fields = [canonical(F.col(f.name), f.dataType).alias(f.name) for f in summary.schema]
    return summary.select(F.to_json(F.struct(*fields), opts).alias("json"))
