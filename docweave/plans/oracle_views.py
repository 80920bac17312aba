"""DuckDB statements of the derived views, used by the SQL oracle.

Each oracle query is prefixed with the views it needs as CTEs, so it runs on
the driver's pre-registered tables alone.
"""

from __future__ import annotations

import re

VIEW_SQL: dict[str, str] = {
    "crawl_docs": r"""
SELECT doc_id AS seq,
  CASE doc_id % 10
    WHEN 0 THEN 'https://github.com/' || source || '/r' || CAST(doc_id AS VARCHAR)
    WHEN 1 THEN 'https://arxiv.org/abs/' || CAST(doc_id AS VARCHAR)
    WHEN 2 THEN 'https://www.linkedin.com/jobs/view/' || CAST(doc_id AS VARCHAR)
    WHEN 3 THEN 'https://medium.com/' || source || '/' || CAST(doc_id AS VARCHAR)
    WHEN 4 THEN 'https://www.wired.com/story/' || CAST(doc_id AS VARCHAR) || '?utm_source=x&id=' || CAST(doc_id AS VARCHAR)
    WHEN 5 THEN 'https://' || source || '.example.com/blog/' || CAST(doc_id AS VARCHAR)
    WHEN 6 THEN 'https://' || source || '.example.com/news/' || CAST(doc_id AS VARCHAR)
    WHEN 7 THEN 'https://x.com/' || source || '/' || CAST(doc_id AS VARCHAR)
    WHEN 8 THEN 'https://' || source || '.example.org/careers/' || CAST(doc_id AS VARCHAR)
    ELSE 'https://' || source || '.example.net/' || lang || '/' || CAST(doc_id AS VARCHAR)
  END AS link,
  regexp_extract(text, '^[^\n]*', 0) AS title,
  text AS content,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE CAST(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS DATE) END AS published_date,
  'agentic ai' AS topic_query,
  lang
FROM documents""",
    "state": """
SELECT link, CASE WHEN seq % 2 = 0 THEN 'blogs' ELSE 'news' END AS collection_name, seq AS state_seq, title, content
FROM crawl_docs WHERE lang <> 'en'""",
    "candidates": """
SELECT seq, link, CASE WHEN seq % 4 = 0 THEN 'blogs' WHEN seq % 4 = 1 THEN 'news' ELSE 'github' END AS collection_name, title, content
FROM crawl_docs
UNION ALL
SELECT seq + 1000000000, link, CASE WHEN seq % 5 = 0 THEN 'news' ELSE 'github' END, title, 'Edited: ' || content
FROM crawl_docs WHERE lang = 'de'""",
    "html_docs": r"""
SELECT doc_id, '<html><head><title> T' || CAST(doc_id AS VARCHAR) || ' </title><meta name="description" content=" D'
  || CAST(doc_id AS VARCHAR) || ' &copy2 &#x80;&notit; &AMP;lt; &Bopf;&#65 &#xD800; &nosuch; &amp"><meta name="keywords" content="A, ' || upper(lang) || ',,' || source || '">'
  || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '<meta property="article:published_time" content="2024-02-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T23:30:00-05:00">' END
  || '</head><body><article><h1>H</h1><p>' || regexp_replace(text, '[<>&"]', ' ', 'g')
  || '</p></article><a class="base-card__full-link" href="/jobs/view/' || CAST(doc_id % 700 AS VARCHAR)
  || '?utm_medium=q">J</a><a href="https://github.com/' || source || '/r' || CAST(doc_id AS VARCHAR)
  || '">G</a><a href="/abs/' || CAST(doc_id AS VARCHAR) || '">P</a><a href="//cdn.example.com/a/b">C</a>'
  || '<a href="https://github.com/shared/r' || CAST(doc_id % 5 AS VARCHAR) || '">G</a><a href="/team/r' || CAST(doc_id % 3 AS VARCHAR)
  || '">G</a><a href="/abs/' || CAST(doc_id % 4 AS VARCHAR) || '">P</a>'
  || CASE WHEN doc_id % 11 = 0 THEN '<p>Ray ID 1 Cloudflare</p>' ELSE '' END || '</body></html>' AS html
FROM documents""",
    "job_docs": r"""
SELECT doc_id AS seq, 'https://www.linkedin.com/jobs/view/' || CAST(doc_id AS VARCHAR) AS link,
  'Engineer ' || CAST(doc_id AS VARCHAR) AS title, 'Acme ' || source AS company, upper(lang) AS location,
  'Full-time' || chr(10) || 'Level ' || CAST(doc_id % 4 AS VARCHAR) AS criteria,
  'About: ' || trim(regexp_replace(text, '[<>&\s\x{A0}]+', ' ', 'g')) AS about
FROM documents""",
    "page_sources": """
SELECT page_id AS source_pos,
  CASE page_id % 5 WHEN 0 THEN 'blogs' WHEN 1 THEN 'github' WHEN 2 THEN 'job_postings' WHEN 3 THEN 'news' ELSE 'research_papers' END AS category,
  CASE WHEN page_id % 20 IN (0, 3) THEN 'https://medium.com/src' || CAST((page_id // 20) % 20 AS VARCHAR) ELSE url END AS source_url,
  html || '<a href="/guides/' || CAST(page_id AS VARCHAR) || '/part-1?utm_source=a&amp;x=1">1</a><a href="/guides/all/part-' || CAST(page_id % 4 AS VARCHAR)
  || '">2</a><a href="/guides/' || CAST(page_id AS VARCHAR) || '/part-1?x=1">1</a><a href="/team' || CAST(page_id % 3 AS VARCHAR) || '/r' || CAST(page_id % 9 AS VARCHAR)
  || '">r</a><a href="https://github.com/lab/r' || CAST(page_id AS VARCHAR) || '">r</a><a href="https://arxiv.org/abs/' || CAST(page_id % 7 AS VARCHAR)
  || '">p</a><a href="https://arxiv.org/abs/9' || CAST(page_id AS VARCHAR) || '">p</a><a href="/jobs/view/' || CAST(page_id % 11 AS VARCHAR) || '">j</a>' AS html
FROM pages""",
    "source_items": """
SELECT 'https://medium.com/feed/' || source AS feed_url, doc_id AS feed_pos, k AS item_pos,
  'https://medium.com/' || source || '/' || CASE WHEN k = 1 THEN CAST(doc_id % 7 AS VARCHAR) ELSE CAST(doc_id AS VARCHAR) END AS link
FROM documents, (VALUES (0), (1), (2)) AS t(k) WHERE doc_id % 13 <> 0""",
    "repo_files": """
SELECT doc_id AS file_id, source AS repo,
  CASE doc_id % 5 WHEN 0 THEN 'docs/readme-' || CAST(doc_id AS VARCHAR) || '.md'
    WHEN 1 THEN 'src/f' || CAST(doc_id AS VARCHAR) || '.py'
    WHEN 2 THEN 'img/p' || CAST(doc_id AS VARCHAR) || '.png'
    WHEN 3 THEN '.git/o' || CAST(doc_id AS VARCHAR)
    ELSE CASE WHEN doc_id % 3 = 0 THEN 'README.rst' WHEN doc_id % 3 = 1 THEN 'readme.md'
              ELSE 'lib/n' || CAST(doc_id AS VARCHAR) || '.txt' END END AS path,
  CAST(length(text) AS BIGINT) AS size_bytes, text
FROM documents""",
    "user_requests": """
SELECT c_custkey AS seq,
  CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_name || ' ' || c_mktsegment
    ELSE c_name || '  van ' || c_mktsegment END AS full_name,
  c_mktsegment
FROM customer""",
    "existing_users": """
SELECT full_name FROM user_requests WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "crawl_results": """
SELECT seq, link,
  CASE WHEN length(content) < 120 THEN 'error' WHEN published_date < DATE '2024-01-10' THEN 'filtered_date_range' ELSE 'ready' END AS status,
  CASE WHEN length(content) < 120 THEN NULL ELSE lower(regexp_extract(link, '^https?://([^/?#]*)', 1)) END AS source_domain,
  CASE WHEN length(content) < 120 THEN NULL ELSE CAST(seq % 11 AS DOUBLE) / 10 END AS ai_relevance_score
FROM crawl_docs""",
    # What each link of a run should become, by construction of its inputs.
    "run_docs": r"""
SELECT seq, link, topic_query, kind,
  CASE kind WHEN 'article' THEN 'Story ' || i WHEN 'job' THEN 'Engineer ' || i WHEN 'repository' THEN 'r' || i
    WHEN 'feed' THEN 'Feed ' || i WHEN 'rendered' THEN 'Post ' || i END AS title,
  CASE kind WHEN 'article' THEN body WHEN 'repository' THEN body WHEN 'feed' THEN 'D' || i || chr(10) || chr(10) || body
    WHEN 'rendered' THEN 'Sub' || chr(10) || 'Site' || chr(10) || 'Post ' || i || chr(10) || 'Sub' || chr(10) || body
    WHEN 'job' THEN 'Job title: Engineer ' || i || chr(10) || 'Company: Acme ' || source || chr(10) || 'Location: ' || upper(lang) || chr(10)
      || 'Full-time' || chr(10) || 'Level ' || CAST(seq % 4 AS VARCHAR) || chr(10) || 'About: ' || trim(regexp_replace(raw, '[<>&\s\x{A0}]+', ' ', 'g')) END AS content,
  CASE WHEN kind = 'article' AND seq % 3 <> 0 THEN CAST('2024-02-' || lpad(CAST(seq % 28 + 1 AS VARCHAR), 2, '0') AS DATE)
    WHEN kind = 'feed' THEN CAST('2024-01-' || lpad(CAST(seq % 28 + 1 AS VARCHAR), 2, '0') AS DATE) END AS published_date,
  CASE kind WHEN 'repository' THEN ['readme', 'r' || i] WHEN 'job' THEN ['Acme ' || source, upper(lang)] ELSE CAST([] AS VARCHAR[]) END AS seeds,
  CASE kind WHEN 'none' THEN 'page not stored'
    WHEN 'bare' THEN 'Repository ' || chr(39) || link || chr(39) || ' does not contain a readable README file.' END AS failure
FROM (SELECT c.seq, c.link, c.topic_query, CAST(c.seq AS VARCHAR) AS i, d.source, d.lang, d.text AS raw,
        trim(regexp_replace(d.text, '[<>&\]\s\x{A0}]+', ' ', 'g')) AS body,
        CASE WHEN c.seq % 10 = 0 THEN CASE WHEN c.seq % 60 = 30 OR trim(regexp_replace(d.text, '[<>&\]\s\x{A0}]+', ' ', 'g')) = '' THEN 'bare' ELSE 'repository' END
             WHEN c.seq % 10 = 2 THEN 'job' WHEN c.seq % 10 <> 3 THEN 'article'
             WHEN c.seq % 30 = 23 THEN 'feed' WHEN c.seq % 30 = 3 THEN 'rendered' ELSE 'none' END AS kind
      FROM crawl_docs c JOIN documents d ON d.doc_id = c.seq)""",
    "feed_docs": r"""
SELECT doc_id, '<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><item><title> T  ' || CAST(doc_id AS VARCHAR)
  || ' </title>' || CASE WHEN doc_id % 9 = 0 THEN '' ELSE '<link>https://medium.com/' || source || '/' || CAST(doc_id AS VARCHAR) || '?utm_source=rss</link>' END
  || '<description>D' || CAST(doc_id AS VARCHAR) || ' &amp;copy2 &amp;#x80;&amp;Bopf;</description><pubDate>Mon, ' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || ' Jan 2024 23:30:00 -0500</pubDate>'
  || CASE WHEN doc_id % 4 = 0 THEN '' ELSE '<content:encoded><![CDATA[<p>C' || CAST(doc_id AS VARCHAR) || ' ' || trim(regexp_replace(text, '[<>&\]\s\x{A0}]+', ' ', 'g')) || '</p>]]></content:encoded>' END
  || CASE WHEN doc_id % 13 = 0 THEN '<broken' ELSE '</item></channel></rss>' END AS xml
FROM documents""",
}

_WORD = re.compile(r"[A-Za-z_]+")


def _deps(name: str) -> list[str]:
    words = set(_WORD.findall(VIEW_SQL[name]))
    return [v for v in VIEW_SQL if v != name and v in words]


def with_views(sql: str, extra_ctes: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of every view it (transitively) names."""
    words = set(_WORD.findall(sql))
    for body in (extra_ctes or {}).values():
        words |= set(_WORD.findall(body))
    needed: list[str] = []

    def visit(v: str) -> None:
        if v in needed:
            return
        for d in _deps(v):
            visit(d)
        needed.append(v)

    for v in VIEW_SQL:
        if v in words:
            visit(v)
    ctes = [f"{v} AS ({VIEW_SQL[v].strip()})" for v in needed]
    ctes += [f"{k} AS ({body.strip()})" for k, body in (extra_ctes or {}).items()]
    if not ctes:
        return sql.strip()
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + sql.strip()
