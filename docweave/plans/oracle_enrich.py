"""DuckDB SQL fragments for the enrichment oracle.

An independent statement of E1-E14 in DuckDB's list functions: keyword
lists are literal lists filtered by a lambda, arg-max is a sorted list of
structs, first-wins distinct is ``list_position(l, x) = i``.
"""

from __future__ import annotations

from ..functions import dictionaries as D

WS = r"[\t\n\x0B\f\r\x1C-\x1F \x85\p{Z}]"
LB = r"[\n\r\x0B\f\x1C\x1D\x1E\x85\x{2028}\x{2029}]"
URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(words) -> str:
    if not words:
        return "CAST([] AS VARCHAR[])"
    return "[" + ", ".join(q(w) for w in words) + "]"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def norm_content(e: str) -> str:
    return strip(f"regexp_replace({e}, '{WS}*{LB}{WS}*', chr(10), 'g')")


def host(e: str) -> str:
    return f"lower(regexp_extract({e}, '{URL_RE}', 2))"


def path(e: str) -> str:
    return f"regexp_replace(regexp_extract({e}, '{URL_RE}', 3), ';[^/]*$', '')"


def any_in(e: str, words) -> str:
    if not words:
        return "false"
    return "(" + " OR ".join(f"contains({e}, {q(w)})" for w in words) + ")"


def topic_kw(topic: str) -> str:
    t = f"lower({strip(topic)})"
    return (f"CASE WHEN {t} = '' THEN CAST([] AS VARCHAR[]) ELSE list_sort(list_distinct(list_concat("
            f"list_filter(regexp_split_to_array({t}, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: length(x) > 2), "
            f"[{t}], CASE WHEN contains({t}, 'ai') OR contains({t}, 'artificial intelligence') "
            f"THEN {lst(D.TOPIC_AI_EXPANSION)} ELSE CAST([] AS VARCHAR[]) END))) END")


def hits(lc: str, words) -> str:
    return f"list_filter({lst(words)}, lambda k: contains({lc}, k))"


def enrich_ctes(src: str, dicts: D.Dictionaries = D.DEFAULT, seed: str = "CAST([] AS VARCHAR[])",
                max_content: int = D.MAX_CONTENT_CHARS, extra_cols: str = "") -> dict[str, str]:
    """CTEs e_gate -> e_base -> e_hits -> e_score -> enriched over ``src``.

    ``src`` must have seq, link, title, content, topic_query (+ extra_cols).
    """
    topics = list(dicts.ai_topics.items())
    kinds = list(dicts.content_kinds.items())
    xc = (", " + extra_cols) if extra_cols else ""
    keep = max_content - len(D.TRUNCATION_MARKER)
    trunc = (f"CASE WHEN length(norm) <= {max_content} THEN norm ELSE "
             f"regexp_replace(substr(norm, 1, {keep}), '{WS}+$', '') || chr(10) || '...[truncated]' END")
    gate = f"""SELECT seq, link, title, topic_query{xc}, {norm_content('coalesce(content, \'\')')} AS norm,
  {seed} AS seed FROM {src}"""
    base = f"""SELECT *, length(norm) >= {D.MIN_CONTENT_CHARS} AS ok, lower(norm) AS lc, {host('link')} AS hst,
  lower({path('link')}) AS pth, lower(coalesce(title, '')) AS title_lc, {topic_kw('topic_query')} AS tkw,
  {trunc} AS cut FROM e_gate"""
    tcols = ",\n  ".join(f"{hits('lc', words)} AS t{i}" for i, (_, words) in enumerate(topics))
    kcols = ",\n  ".join(
        f"{{'s': -len({hits('lc', words)}), 'r': {i}, 'k': {q(k)}}}" for i, (k, words) in enumerate(kinds))
    hit = f"""SELECT *,
  {tcols},
  list_sort(list_filter(tkw, lambda k: contains(lc, k))) AS topic_hits,
  list_sort({hits('lc', dicts.job_roles)}) AS roles,
  list_sort({hits('lc', dicts.job_market)}) AS market,
  list_sort([{kcols}])[1] AS best_kind,
  CASE WHEN length(norm) > {max_content} THEN lower(cut) ELSE lc END AS cut_lc
FROM e_base"""
    tsorted = ", ".join(f"{{'s': -len(t{i}), 'r': {i}, 't': {q(name)}}}" for i, (name, _) in enumerate(topics))
    allt = " || ".join(f"t{i}" for i in range(len(topics)))
    score = f"""SELECT *,
  list_sort(list_distinct({allt})) AS ai_hits,
  list_transform(list_filter(list_sort([{tsorted}]), lambda x: x.s < 0), lambda x: x.t) AS ai_topics,
  len(roles) + len(market) > 0 AS has_job_signal,
  round(least(1.0, (len(roles) + len(market)) / 8.0), 4) AS hiring_signal_score,
  CASE WHEN contains(hst, 'github.com') THEN 'project'
       WHEN hst IN ({', '.join(q(d) for d in dicts.social_domains)}) THEN 'impact'
       WHEN best_kind.s < 0 THEN best_kind.k ELSE 'general' END AS kind0
FROM e_hits"""
    research = f"(hst IN ({', '.join(q(d) for d in dicts.research_domains)}) OR {any_in('pth', D.RESEARCH_PATH_TOKENS)})"
    job = (f"(hst IN ({', '.join(q(d) for d in dicts.job_domains)}) OR {any_in('hst || pth', D.JOB_URL_TOKENS)} "
           f"OR has_job_signal OR content_kind = 'job_market' OR {any_in('title_lc', dicts.job_title_signals)})")
    blog = (f"(hst IN ({', '.join(q(d) for d in dicts.blog_domains)}) OR contains(hst, 'blog') "
            f"OR starts_with(pth, '/blog') OR contains(pth, '/blog/'))")
    news = (f"(hst IN ({', '.join(q(d) for d in dicts.news_domains)}) OR contains(hst, 'news') "
            f"OR starts_with(pth, '/news') OR contains(pth, '/news/') OR content_kind = 'news' "
            f"OR {any_in('title_lc', dicts.news_signals)} OR {any_in('cut_lc', dicts.news_signals)})")
    curated = ", ".join(q(x) for x in dicts.curated_links)
    tagsrc = "list_filter(list_transform(list_concat(seed, topic_hits, ai_hits, roles, market), " \
             f"lambda x: lower({strip('x')})), lambda x: x <> '')"
    final0 = f"""SELECT *,
  CASE WHEN has_job_signal AND kind0 = 'general' THEN 'job_market' ELSE kind0 END AS content_kind,
  list_sort(list_distinct(list_concat(ai_hits, topic_hits))) AS ai_keywords,
  {tagsrc} AS tag_src
FROM e_score"""
    final = f"""SELECT seq, link, title, topic_query{xc}, ok AS has_document, cut AS content,
  CASE WHEN ok THEN 'ready' ELSE 'error' END AS status,
  hst AS source_domain, content_kind,
  len(ai_keywords) > 0 OR link IN ({curated}) AS is_ai_related,
  round(greatest(least(1.0, len(ai_hits) / 10.0),
                 least(1.0, len(topic_hits) / greatest(1, least(8, len(tkw)))),
                 least(1.0, len(ai_keywords) / 12.0)), 4) AS ai_relevance_score,
  ai_topics, ai_keywords, has_job_signal, roles AS job_roles, hiring_signal_score,
  list_slice(list_filter(tag_src, lambda x, i: list_position(tag_src, x) = i), 1, {D.MAX_TAGS}) AS tags,
  CASE WHEN github THEN 'github' WHEN research THEN 'research_papers' WHEN job THEN 'job_postings'
       WHEN blog THEN 'blogs' WHEN news THEN 'news' ELSE 'blogs' END AS collection_name
FROM (SELECT *, contains(hst, 'github.com') AS github, {research} AS research, {job} AS job,
             {blog} AS blog, {news} AS news FROM e_final0)"""
    return {"e_gate": gate, "e_base": base, "e_hits": hit, "e_score": score, "e_final0": final0,
            "enriched": final}
