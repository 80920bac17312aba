"""DuckDB SQL fragments for URL, anchor and link oracles."""

from __future__ import annotations

from ..functions import dictionaries as D
from .oracle_enrich import URL_RE, q, strip

INERT = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def part(e: str, i: int) -> str:
    return f"regexp_extract({e}, '{URL_RE}', {i})"


def scheme(e: str) -> str:
    return f"lower({part(e, 1)})"


def netloc(e: str) -> str:
    return part(e, 2)


def host(e: str) -> str:
    return f"lower({part(e, 2)})"


def spath(e: str) -> str:
    return part(e, 3)


def path(e: str) -> str:
    return f"regexp_replace({part(e, 3)}, ';[^/]*$', '')"


def unsplit(s: str, n: str, p: str, qu: str, f: str) -> str:
    return (f"((CASE WHEN {s} <> '' THEN {s} || ':' ELSE '' END) || "
            f"(CASE WHEN {n} <> '' OR {s} IN ('http', 'https', 'ftp') THEN '//' || {n} || "
            f"(CASE WHEN {p} <> '' AND NOT starts_with({p}, '/') THEN '/' ELSE '' END) || {p} ELSE {p} END) || "
            f"(CASE WHEN {qu} <> '' THEN '?' || {qu} ELSE '' END) || (CASE WHEN {f} <> '' THEN '#' || {f} ELSE '' END))")


def _dec(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _enc(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def normalize(e: str) -> str:
    """U2 on an expression (evaluated on the stripped text)."""
    s = strip(e)
    key = "split_part(x, '=', 1)"
    val = "CASE WHEN contains(x, '=') THEN substr(x, strpos(x, '=') + 1) ELSE '' END"
    newq = (f"array_to_string(list_transform(list_filter(list_filter(string_split({part(s, 4)}, '&'), "
            f"lambda x: x <> ''), lambda x: NOT starts_with(lower({_dec(key)}), 'utm_')), "
            f"lambda x: {_enc(_dec(key))} || '=' || {_enc(_dec(val))}), '&')")
    return (f"(CASE WHEN {part(s, 4)} = '' THEN {s} ELSE "
            f"{unsplit(scheme(s), netloc(s), spath(s), newq, part(s, 5))} END)")


def join_simple(base: str, href: str) -> str:
    """urljoin for the reference forms present in the data: absolute,
    protocol-relative and rooted (no dot segments)."""
    return (f"(CASE WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {href} "
            f"WHEN starts_with({href}, '//') THEN {scheme(base)} || ':' || {href} "
            f"WHEN starts_with({href}, '/') THEN {scheme(base)} || '://' || {netloc(base)} || {href} END)")


def is_http(e: str) -> str:
    return f"({scheme(e)} IN ('http', 'https') AND {netloc(e)} <> '')"


def unescape(e: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"),
                    ("&apos;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        e = f"replace({e}, {q(ent)}, {q(ch)})"
    return e


def attr(tag: str, name: str) -> tuple[str, str]:
    pat = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    pq = q(pat)
    val = f"(regexp_extract({tag}, {pq}, 1) || regexp_extract({tag}, {pq}, 2) || regexp_extract({tag}, {pq}, 3))"
    return f"regexp_matches({tag}, {q(rf'(?is)\s{name}\s*=')})", unescape(val)


def anchors_sql(src: str, keep: str) -> str:
    """L1 over ``src`` (with an ``html`` column): keep, pos, href, anchor_class."""
    has, href = attr("tag", "href")
    _, cls = attr("tag", "class")
    return f"""SELECT {keep}, pos, {strip(href)} AS href, {cls} AS anchor_class
FROM (SELECT {keep}, unnest(t) AS tag, unnest(range(len(t))) AS pos
      FROM (SELECT {keep}, regexp_extract_all(regexp_replace(html, {q(INERT)}, ' ', 'g'), '(?is)<a\\b[^>]*>', 0) AS t
            FROM {src}))
WHERE {has}"""


def likely_content(src_url: str, link: str, min_depth: int) -> str:
    sp = f"regexp_replace({path(src_url)}, '/+$', '')"
    p = f"regexp_replace({path(link)}, '/+$', '')"
    blocked = " OR ".join(f"contains(lower({p}), {q(t)})" for t in D.BLOCKED_LINK_TOKENS)
    return (f"({p} <> '' AND {p} <> {sp} AND NOT ({blocked}) "
            f"AND length({p}) - length(replace({p}, '/', '')) >= {min_depth})")


def is_repo(link: str) -> str:
    parts = f"list_filter(string_split({path(link)}, '/'), lambda x: x <> '')"
    blocked = ", ".join(q(x) for x in D.BLOCKED_REPO_SEGMENTS)
    return (f"({host(link)} IN ('github.com', 'www.github.com') AND len({parts}) = 2 "
            f"AND lower({parts}[1]) NOT IN ({blocked}))")


def is_paper(link: str) -> str:
    return f"({host(link)} IN ('arxiv.org', 'www.arxiv.org') AND starts_with({path(link)}, '/abs/'))"
