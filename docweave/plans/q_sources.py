"""Feed and repository-file queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..operators import documents as P
from ..sources import feeds as FD
from ..sources import repos as R
from ..sources import views as V
from .oracle_enrich import enrich_ctes, q, strip
from .registry import joined, register

# Expected feed items by construction, read from each feed string with
# regular expressions (no XML parser): well-formed feeds with a link.
_ITEMS = """SELECT doc_id,
  regexp_replace(regexp_extract(xml, '<link>([^<?]*)', 1), '\\?.*$', '') AS link,
  regexp_replace(trim(regexp_extract(xml, '<title>([^<]*)</title>', 1)), '\\s+', ' ', 'g') AS title,
  replace(regexp_extract(xml, '<description>([^<]*)</description>', 1), '&amp;copy2 &amp;#x80;&amp;Bopf;', '©2 €𝔹') AS description,
  coalesce(nullif(regexp_extract(xml, '<!\\[CDATA\\[<p>([^<]*)</p>\\]\\]>', 1), ''),
           replace(regexp_extract(xml, '<description>([^<]*)</description>', 1), '&amp;copy2 &amp;#x80;&amp;Bopf;', '©2 €𝔹')) AS content,
  regexp_extract(xml, '<pubDate>([^<]*)</pubDate>', 1) AS published_at
FROM feed_docs WHERE NOT ends_with(xml, '<broken') AND contains(xml, '<link>')"""


def _items(spark, sf) -> DataFrame:
    return FD.feed_items(V.feed_docs(spark, sf))


@register("s5_feed_items", "SELECT * FROM items", {"items": _ITEMS})
def s5_feed_items(spark: SparkSession, sf: str) -> DataFrame:
    """Linked http items of every stored feed (malformed feeds: none)."""
    return _items(spark, sf).select("doc_id", "link", "title", "description", "content", "published_at")


@register("l7_feed_links", """
SELECT doc_id, link, 'https://medium.com/feed/' || split_part(substr(link, 20), '/', 1) AS feed_url,
  CAST(1 AS BIGINT) AS feed_rank
FROM items""", {"items": _ITEMS})
def l7_feed_links(spark: SparkSession, sf: str) -> DataFrame:
    """L7 (+L15): http links of every stored feed, distinct, first 3."""
    out = FD.feed_links(_items(spark, sf), 3, source="doc_id")
    return out.select("doc_id", "link", "feed_url", F.col("feed_rank").cast("bigint").alias("feed_rank"))


@register("l13_feed_lookup", """
SELECT c.seq, c.link, i.title, i.content FROM crawl_docs c LEFT JOIN items i ON i.link = c.link""",
          {"items": _ITEMS})
def l13_feed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Feed entry of every document link (by normalised link)."""
    m = FD.lookup_entries(V.crawl_docs(spark, sf).select("seq", "link"), _items(spark, sf))
    return m.select("seq", "link", "title", "content")


_FEED_ART = """SELECT c.seq, c.link, i.title, i.description || chr(10) || chr(10) || i.content AS content, 'agentic ai' AS topic_query
FROM crawl_docs c JOIN items i ON i.link = c.link"""


@register("h11_feed_documents", """
SELECT seq, status, title, collection_name, 'medium' AS platform, CAST(substr(published, 13, 4) || '-01-' || substr(published, 6, 2) AS DATE) AS published_date
FROM enriched JOIN (SELECT doc_id, published_at AS published FROM items) ON doc_id = seq WHERE has_document
UNION ALL SELECT seq, status, NULL, NULL, NULL, NULL FROM enriched WHERE NOT has_document""",
          {"items": _ITEMS, "feed_art": _FEED_ART, **enrich_ctes("feed_art")})
def h11_feed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """H11 (+L13, P2, E11): feed-backed article documents."""
    links = V.crawl_docs(spark, sf).select("seq", "link").withColumn("topic_query", F.lit(V.TOPIC))
    m = FD.lookup_entries(links, _items(spark, sf)).filter(F.col("feed_url").isNotNull())
    docs = P.build_documents(FD.feed_documents(m), topic=V.TOPIC)
    return docs.select("seq", "status", "title", "collection_name", "platform", "published_date")


_RANK = "CASE path " + " ".join(f"WHEN {q(n)} THEN {i}" for i, n in enumerate(D.README_PREFERRED_NAMES)) + \
    f" ELSE CASE WHEN starts_with(lower(regexp_extract(path, '([^/]*)$', 1)), 'readme') AND NOT " \
    f"list_contains(string_split(path, '/'), '.git') THEN {len(D.README_PREFERRED_NAMES)} END END"


@register("s7_readme_pick", f"""
SELECT repo, b.p AS readme_path, md5(b.t) AS readme_md5 FROM (
  SELECT repo, min({{'r': r, 'p': path, 'i': file_id, 't': text}}) AS b FROM (SELECT *, {_RANK} AS r FROM repo_files)
  WHERE r IS NOT NULL AND {strip('text')} <> '' GROUP BY repo)""")
def s7_readme_pick(spark: SparkSession, sf: str) -> DataFrame:
    """README per repository (preferred root names, else readme* by path)."""
    r = R.readme_pick(V.repo_files(spark, sf))
    return r.select("repo", "readme_path", F.md5("readme").alias("readme_md5"))


_EXT = "regexp_extract(lower(regexp_extract(path, '([^/]*)$', 1)), '(\\.[^.]*)$', 1)"


@register("s8_repo_file_filter", f"""
SELECT repo, path, (len(list_filter(string_split(lower(path), '/'), lambda x: starts_with(x, '.git'))) > 0
  OR ({_EXT} IN ({', '.join(q(x) for x in D.BINARY_FILE_EXTENSIONS)})
      AND {_EXT} <> lower(regexp_extract(path, '([^/]*)$', 1)))) AS skipped
FROM repo_files""")
def s8_repo_file_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Repository files left out (.git parts, binary extensions)."""
    f = V.repo_files(spark, sf)
    return f.select("repo", "path", R.skip_file("path").alias("skipped"))


_REPO_ART = f"""SELECT crc AS seq, 'https://github.com/owner/' || repo AS link, repo AS title, t AS content, 'agentic ai' AS topic_query, repo
FROM (SELECT DISTINCT repo, 0 AS crc FROM repo_files) LEFT JOIN (
  SELECT repo, min({{'r': r, 'p': path, 'i': file_id, 't': text}}).t AS t FROM (SELECT *, {_RANK} AS r FROM repo_files)
  WHERE r IS NOT NULL AND {strip('text')} <> '' GROUP BY repo) USING (repo)"""


@register("h13_repository_documents", """
SELECT repo, status, title, collection_name, array_to_string(tags, '|') AS tags FROM enriched WHERE has_document
UNION ALL SELECT repo, status, NULL, NULL, NULL FROM enriched WHERE NOT has_document""",
          {"repo_art": _REPO_ART, **enrich_ctes("repo_art", seed="['readme', lower(repo)]", extra_cols="repo")})
def h13_repository_documents(spark: SparkSession, sf: str) -> DataFrame:
    """H13 (+S7, P2, E11): one README document per repository; without README an error row."""
    files = V.repo_files(spark, sf)
    r = files.select("repo").distinct().join(R.readme_pick(files), "repo", "left").withColumn(
        "link", F.concat(F.lit("https://github.com/owner/"), F.col("repo")))
    rec = R.repository_records(r).withColumns({"seq": F.crc32("repo"), "topic_query": F.lit(V.TOPIC)})
    docs = P.build_documents(rec, topic=V.TOPIC, seed_tags="seed_tags")
    return docs.select("repo", "status", "title", "collection_name", joined("tags").alias("tags"))


_WALK = f"""
  SELECT repo, path, file_id, text, size_bytes > {D.REPO_SKIP_FILE_BYTES} AS big, length(text) > {D.REPO_MAX_FILE_CHARS} AS cut,
    length(path) + CASE WHEN length(text) > {D.REPO_MAX_FILE_CHARS} THEN {D.REPO_MAX_FILE_CHARS + len(D.TRUNCATION_MARKER)} ELSE length(text) END AS n
  FROM repo_files WHERE {strip('text')} <> ''
    AND NOT (len(list_filter(string_split(lower(path), '/'), lambda x: starts_with(x, '.git'))) > 0
      OR ({_EXT} IN ({', '.join(q(x) for x in D.BINARY_FILE_EXTENSIONS)}) AND {_EXT} <> lower(regexp_extract(path, '([^/]*)$', 1))))"""


@register("s9_s10_repository_corpus", f"""
, w AS ({_WALK}),
o AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY path, file_id) AS k FROM w WHERE NOT big),
f AS (
  SELECT repo, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS total, CAST(0 AS BIGINT) AS files, false AS trimmed, false AS stop, CAST(NULL AS BIGINT) AS taken
  FROM (SELECT DISTINCT repo FROM repo_files)
  UNION ALL
  SELECT f.repo, f.k + 1, CASE WHEN total + n <= {D.REPO_MAX_TOTAL_CHARS} THEN total + n ELSE total END,
    CASE WHEN total + n <= {D.REPO_MAX_TOTAL_CHARS} THEN files + 1 ELSE files END,
    trimmed OR cut OR total + n > {D.REPO_MAX_TOTAL_CHARS} OR files + 1 >= {D.REPO_MAX_FILES} OR total + n >= {D.REPO_MAX_TOTAL_CHARS},
    total + n <= {D.REPO_MAX_TOTAL_CHARS} AND (files + 1 >= {D.REPO_MAX_FILES} OR total + n >= {D.REPO_MAX_TOTAL_CHARS}),
    CASE WHEN total + n <= {D.REPO_MAX_TOTAL_CHARS} THEN file_id END
  FROM f JOIN o ON o.repo = f.repo AND o.k = f.k + 1 WHERE NOT f.stop),
flag AS (SELECT repo, bool_or(trimmed) OR coalesce((SELECT bool_or(big) FROM w WHERE w.repo = f.repo), false) AS trimmed FROM f GROUP BY repo),
body AS (SELECT f.repo, count(*) AS files, string_agg('FILE: ' || path || chr(10) || CASE WHEN cut THEN substr(text, 1, {D.REPO_MAX_FILE_CHARS}) || chr(10) || '...[truncated]'
    ELSE text END, chr(10) || chr(10) ORDER BY path, file_id) AS corpus FROM f JOIN o ON o.file_id = f.taken GROUP BY f.repo),
c AS (SELECT repo, trimmed, coalesce(files, 1) AS files, coalesce(corpus, 'FILE: README' || chr(10) || '{D.EMPTY_REPOSITORY}') AS corpus FROM flag LEFT JOIN body USING (repo))
SELECT repo, trimmed, files, length(corpus) AS chars, md5(corpus) AS corpus_md5 FROM c""")
def s9_s10_repository_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Budgeted per-repository corpus text (skip-and-continue fold)."""
    c = R.repository_corpus(V.repo_files(spark, sf))
    return c.select("repo", "trimmed", "files", F.length("corpus").cast("bigint").alias("chars"),
                    F.md5("corpus").alias("corpus_md5"))
