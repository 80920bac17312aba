"""Merge, store, load and run-metric queries (M1, M2, J1, J2, S12, S13, S15, S16, P1,
U6, P4, P12, A2, A3, A4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from ..operators import documents as P
from ..operators import merge as M
from ..operators import metrics as A
from ..operators import store as ST
from ..functions import dates as DT
from ..functions import text as T
from ..sources import views as V
from ..sources.tables import read_table
from .oracle_enrich import enrich_ctes
from .q_analytics import COLLECTION_CASE, enriched_docs
from .registry import register
from ..session import saved, work_folder

RUN_START = dt.date(2024, 1, 10)
RUN_END = dt.date(2024, 2, 20)

_RANK = COLLECTION_CASE
_CUR = f"SELECT link, arg_min(collection_name, {_RANK}) AS existing FROM state GROUP BY link"
_ACTIONS = f"""SELECT c.seq, c.link, c.collection_name, p.prev AS previous_collection,
  CASE WHEN p.prev IS NULL THEN 'inserted' WHEN p.prev = c.collection_name THEN 'duplicate' ELSE 'moved' END AS action
FROM candidates c JOIN (
  SELECT seq, coalesce(lag(collection_name) OVER (PARTITION BY link ORDER BY seq), cur.existing) AS prev
  FROM candidates LEFT JOIN cur USING (link)) p USING (seq)"""


def _store(spark, sf) -> DataFrame:
    return V.state(spark, sf)


def _actions(spark, sf) -> DataFrame:
    """M1 on keys alone."""
    keys = V.candidates(spark, sf).select("seq", "link", "collection_name")
    return M.merge_actions(keys, _store(spark, sf).select("link", "collection_name"))


@register("m1_merge_actions", """SELECT a.seq, a.link, a.collection_name, previous_collection, action, title, md5(content) AS content_md5
FROM acts a JOIN candidates c ON a.seq = c.seq""", {"cur": _CUR, "acts": _ACTIONS})
def m1_merge_actions(spark: SparkSession, sf: str) -> DataFrame:
    """M1 (+J1, W4): insert / duplicate / move per candidate against the store; its document joins after the merge."""
    documents = V.candidates(spark, sf).select("seq", "title", F.md5("content").alias("content_md5"))
    return _actions(spark, sf).join(documents, "seq").select(
        "seq", "link", "collection_name", "previous_collection", "action", "title", "content_md5")


_NEW_STATE = """
SELECT link, collection_name, 'store' AS origin, state_seq AS row_seq, title, md5(content) AS content_md5 FROM state
WHERE link NOT IN (SELECT link FROM acts WHERE action <> 'duplicate')
UNION ALL
SELECT link, collection_name, 'batch', seq, title, md5(content) FROM candidates
WHERE seq IN (SELECT max(seq) FROM acts WHERE action <> 'duplicate' GROUP BY link)"""


@register("m2_new_state", _NEW_STATE, {"cur": _CUR, "acts": _ACTIONS})
def m2_new_state(spark: SparkSession, sf: str) -> DataFrame:
    """M2: store after the merge, with full documents (untouched rows + last non-duplicate candidate)."""
    st = M.new_state(_store(spark, sf), _actions(spark, sf), V.candidates(spark, sf))
    return st.select("link", "collection_name",
                     F.when(F.col("seq").isNull(), "store").otherwise("batch").alias("origin"),
                     F.coalesce("seq", "state_seq").alias("row_seq"), "title", F.md5("content").alias("content_md5"))


STORE_SCHEMA = TY.StructType([*[TY.StructField(c, TY.StringType()) for c in ("id", "link", "collection_name", "title", "content")],
                        *[TY.StructField(c, TY.TimestampType()) for c in ("created_at", "updated_at")]])
STORED_ON, MERGED_ON = "2024-01-01", "2024-03-01"


@register("s12_store_write", f"""
SELECT substr(md5(link), 1, 8) || '-' || substr(md5(link), 9, 4) || '-' || substr(md5(link), 13, 4) || '-' || substr(md5(link), 17, 4)
    || '-' || substr(md5(link), 21, 12) AS id, link, collection_name, title, content_md5,
  CASE WHEN link IN (SELECT link FROM state) THEN '{STORED_ON}' ELSE '{MERGED_ON}' END AS created_on,
  CASE WHEN origin = 'store' THEN '{STORED_ON}' ELSE '{MERGED_ON}' END AS updated_on,
  CAST(2 AS BIGINT) AS version
FROM ({_NEW_STATE})""", {"cur": _CUR, "acts": _ACTIONS})
def s12_store_write(spark: SparkSession, sf: str) -> DataFrame:
    """S12 (+P1's id and times, M1, M2): a first version of the store, a batch merged into its buckets, read again."""
    root = work_folder(spark)
    day = lambda d: F.lit(f"{d} 00:00:00").cast("timestamp")
    first = _store(spark, sf).select(M.document_id().alias("id"), "link", "collection_name", "title", "content",
                                     day(STORED_ON).alias("created_at"), day(STORED_ON).alias("updated_at"))
    ST.create_store(first, root)
    version, _ = ST.merge_batch(spark, root, STORE_SCHEMA, V.candidates(spark, sf), now=day(MERGED_ON))
    return ST.read_store(spark, root, STORE_SCHEMA).select(
        "id", "link", "collection_name", "title", F.md5("content").alias("content_md5"),
        F.date_format("created_at", "yyyy-MM-dd").alias("created_on"), F.date_format("updated_at", "yyyy-MM-dd").alias("updated_on"),
        F.lit(version).cast("bigint").alias("version"))


@register("j2_link_exists", """
SELECT c.seq, c.link, c.collection_name FROM candidates c
WHERE EXISTS (SELECT 1 FROM state s WHERE s.link = c.link AND s.collection_name = c.collection_name)""")
def j2_link_exists(spark: SparkSession, sf: str) -> DataFrame:
    """J2 (+P13): candidates whose link already lies in their collection."""
    return M.link_exists(V.candidates(spark, sf).select("seq", "link", "collection_name"), _store(spark, sf))


@register("j1_existing_collection", """
SELECT c.seq, c.link, cur.existing AS existing_collection FROM candidates c LEFT JOIN cur USING (link)
""", {"cur": _CUR})
def j1_existing_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Collection already holding each candidate's link (first in order)."""
    cur = M.current_collection(_store(spark, sf))
    return (V.candidates(spark, sf).join(cur, "link", "left")
            .select("seq", "link", "existing_collection"))


@register("s13_delete_moved", """
SELECT s.link, s.collection_name FROM state s
WHERE NOT EXISTS (SELECT 1 FROM acts a WHERE a.action = 'moved' AND a.previous_collection = s.collection_name
                  AND a.link = s.link)
""", {"cur": _CUR, "acts": _ACTIONS})
def s13_delete_moved(spark: SparkSession, sf: str) -> DataFrame:
    """S13 (+P13): delete the stored copies that the merge moves away."""
    moved = (_actions(spark, sf).filter(F.col("action") == "moved")
             .select(F.col("previous_collection").alias("collection_name"), "link"))
    return P.key_projection(M.delete_links(_store(spark, sf), moved)).select("link", "collection_name")


@register("s15_new_users", """
SELECT full_name,
  CASE WHEN len(t) = 1 THEN t[1] ELSE array_to_string(t[1:len(t)-1], ' ') END AS first_name,
  t[len(t)] AS last_name
FROM (SELECT full_name, list_filter(string_split(full_name, ' '), lambda x: x <> '') AS t
      FROM (SELECT DISTINCT full_name FROM user_requests
            WHERE full_name NOT IN (SELECT full_name FROM existing_users)))
""")
def s15_new_users(spark: SparkSession, sf: str) -> DataFrame:
    """Requested users missing from the dimension, with split names."""
    new = M.resolve_users(V.user_requests(spark, sf), V.existing_users(spark, sf))
    return new.select("full_name", "first_name", "last_name")


@register("p5_run_window", """
SELECT o_orderkey, start_date, end_date, CASE WHEN start_date IS NULL THEN 'Invalid date ' || chr(39) || s || chr(39) || '. Use YYYY-MM-DD.'
  WHEN end_date IS NULL THEN 'Invalid date ' || chr(39) || e || chr(39) || '. Use YYYY-MM-DD.'
  WHEN start_date > end_date THEN 'start date cannot be after end date' END AS problem
FROM (SELECT o_orderkey, s, e, CASE WHEN s IS NULL THEN CAST(today - 30 AS DATE) WHEN contains(s, '13-40') OR contains(s, '/') THEN NULL ELSE today END AS start_date,
        CASE WHEN e IS NULL THEN today WHEN contains(e, 'soon') THEN NULL ELSE CAST(today - 3 AS DATE) END AS end_date
      FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS today,
              CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') WHEN 2 THEN '2024-13-40'
                WHEN 3 THEN strftime(CAST(o_orderdate AS DATE), '%Y%m%d') ELSE '1/2/2024' END AS s,
              CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN strftime(CAST(CAST(o_orderdate AS DATE) - 3 AS DATE), '%Y-%m-%d') ELSE 'soon' END AS e
            FROM orders))
""")
def p5_run_window(spark: SparkSession, sf: str) -> DataFrame:
    """The date window of runs started on the orders' days, some with bad or crossed parameters."""
    today = F.col("o_orderdate").cast("date")
    key = F.col("o_orderkey")
    runs = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"]).select(
        key, today.alias("today"),
        F.when(key % 5 == 1, today.cast("string")).when(key % 5 == 2, "2024-13-40").when(key % 5 == 3, F.date_format(today, "yyyyMMdd"))
        .when(key % 5 == 4, "1/2/2024").alias("s"),
        F.when(key % 3 == 1, F.date_sub(today, 3).cast("string")).when(key % 3 == 2, "soon").alias("e"))
    window = DT.window_parameters("s", "e", "today")
    return runs.select("o_orderkey", *[c.alias(name) for name, c in window.items()])


@register("u6_split_name", """
SELECT seq, full_name,
  CASE WHEN len(t) = 1 THEN t[1] ELSE array_to_string(t[1:len(t)-1], ' ') END AS first_name,
  t[len(t)] AS last_name
FROM (SELECT seq, full_name, list_filter(string_split(full_name, ' '), lambda x: x <> '') AS t FROM user_requests)
""")
def u6_split_name(spark: SparkSession, sf: str) -> DataFrame:
    """first/last name split on single spaces (double spaces collapse)."""
    parts = T.split_full_name("full_name")
    return V.user_requests(spark, sf).select("seq", "full_name", parts["first_name"].alias("first_name"),
                                             parts["last_name"].alias("last_name"))


@register("s16_key_audit", """
SELECT 'candidates.link' AS rule, link AS key_value, count(*) AS occurrences FROM candidates GROUP BY link HAVING count(*) > 1
UNION ALL
SELECT 'state.collection_link', collection_name || ' ' || link, count(*) FROM state GROUP BY collection_name, link HAVING count(*) > 1
UNION ALL
SELECT 'users.full_name', full_name, count(*) FROM user_requests GROUP BY full_name HAVING count(*) > 1
""")
def s16_key_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Unique-key rules as a data audit (link per batch, link per
    collection, user name)."""
    a = M.key_violations(V.candidates(spark, sf), ["link"]).select(
        F.lit("candidates.link").alias("rule"), F.col("link").alias("key_value"), "occurrences")
    b = M.key_violations(V.state(spark, sf), ["collection_name", "link"]).select(
        F.lit("state.collection_link").alias("rule"),
        F.concat_ws(" ", "collection_name", "link").alias("key_value"), "occurrences")
    c = M.key_violations(V.user_requests(spark, sf), ["full_name"]).select(
        F.lit("users.full_name").alias("rule"), F.col("full_name").alias("key_value"), "occurrences")
    return a.unionByName(b).unionByName(c)


@register("a2_domain_metrics", """
SELECT coalesce(source_domain, 'unknown') AS source_domain, count(*) AS total,
  CAST(count_if(status = 'ready') AS BIGINT) AS saved,
  CAST(count_if(status = 'filtered_non_ai') AS BIGINT) AS filtered_non_ai,
  CAST(count_if(status = 'error') AS BIGINT) AS errors,
  round(sum(coalesce(ai_relevance_score, 0)) / count(*), 4) AS avg_ai_relevance_score
FROM crawl_results GROUP BY 1
""")
def a2_domain_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A2: per-domain run metrics (unknown bucket for rows without metadata)."""
    return A.domain_metrics(V.crawl_results(spark, sf))


@register("p12_load_outcome", """
SELECT seq, status, CASE WHEN status = 'error' THEN 'error'
  WHEN status IN ('filtered_non_ai', 'filtered_date_range') THEN 'skipped' ELSE 'candidate' END AS outcome
FROM crawl_results
""")
def p12_load_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """Error / skipped / candidate partition of run results."""
    r = V.crawl_results(spark, sf).withColumn("has_document", F.col("status") == "ready")
    return r.select("seq", "status", P.load_outcome().alias("outcome"))


# --- one run end to end: enrich -> date window -> outcome -> merge -------

def run_actions(spark: SparkSession, sf: str) -> DataFrame:
    """crawl_docs -> E11 -> P4 -> P12 -> M1 against the store."""
    results = P.apply_date_filter(enriched_docs(spark, sf, columns=("collection_name",)), RUN_START, RUN_END)
    results = results.withColumn("outcome", P.load_outcome())
    cols = ["seq", "link", "collection_name", "status", "reason", "outcome"]
    # the merge reads its input in two branches: checkpoint the enriched
    # results once (shared checkpoint folder) instead of enriching twice
    results = saved(results.select(*cols))
    return M.merge_actions(results, _store(spark, sf), outcome="outcome")


_RUN_CTES = {
    **enrich_ctes("crawl_docs", extra_cols="published_date"),
    "res0": f"""SELECT seq, link, CASE WHEN has_document THEN collection_name END AS collection_name,
  CASE WHEN NOT has_document THEN 'error'
       WHEN published_date < DATE '{RUN_START}' THEN 'filtered_date_range'
       WHEN published_date > DATE '{RUN_END}' THEN 'filtered_date_range' ELSE 'ready' END AS status,
  CASE WHEN NOT has_document THEN 'insufficient_content: extracted ' || CAST(length(content) AS VARCHAR) || ' chars'
       WHEN published_date < DATE '{RUN_START}' THEN 'published_before_start_date'
       WHEN published_date > DATE '{RUN_END}' THEN 'published_after_end_date' END AS reason
FROM enriched""",
    "res": """SELECT *, CASE WHEN status = 'error' THEN 'error' WHEN status = 'filtered_date_range' THEN 'skipped'
  ELSE 'candidate' END AS outcome FROM res0""",
    "cur": _CUR,
    "racts": """SELECT *, CASE WHEN outcome <> 'candidate' THEN outcome WHEN prev IS NULL THEN 'inserted'
  WHEN prev = collection_name THEN 'duplicate' ELSE 'moved' END AS action
FROM (SELECT r.*, CASE WHEN outcome = 'candidate' THEN coalesce(last_value(CASE WHEN outcome = 'candidate'
        THEN collection_name END IGNORE NULLS) OVER (PARTITION BY link ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), cur.existing) END AS prev
      FROM res r LEFT JOIN cur USING (link))""",
}


@register("p4_date_filter", "SELECT seq, status, reason FROM res", _RUN_CTES)
def p4_date_filter(spark: SparkSession, sf: str) -> DataFrame:
    """P4 (+P2, U3, U5): run results after the inclusive date window; missing dates kept."""
    results = P.apply_date_filter(enriched_docs(spark, sf, columns=()), RUN_START, RUN_END)
    return results.select("seq", "status", "reason")


@register("a3_load_counters", """
SELECT CAST(count_if(action = 'inserted') AS BIGINT) AS saved_count,
  CAST(count_if(action = 'moved') AS BIGINT) AS moved_count,
  CAST(count_if(action = 'duplicate') AS BIGINT) AS duplicate_count,
  CAST(count_if(action = 'skipped') AS BIGINT) AS skipped_count,
  CAST(count_if(action = 'error') AS BIGINT) AS error_count FROM racts
""", _RUN_CTES)
def a3_load_counters(spark: SparkSession, sf: str) -> DataFrame:
    """A3 (+E11, P4, P12, M1): load counters of one run against the store."""
    return A.load_counters(run_actions(spark, sf))


@register("a4_per_collection", """
SELECT collection_name, count(*) AS documents FROM racts WHERE action IN ('inserted', 'moved') GROUP BY 1
""", _RUN_CTES)
def a4_per_collection(spark: SparkSession, sf: str) -> DataFrame:
    """A4: inserted + moved documents per target collection in one run."""
    return A.per_collection_counts(run_actions(spark, sf))
