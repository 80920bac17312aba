"""URL column functions (Column -> Column), all JVM-side.

URL parts come from the RFC 3986 appendix-B regular expression, which splits
the way ``urllib.parse.urlsplit`` does (scheme lower-cased, authority kept
whole, query and fragment optional).  ``try_parse_url`` is not used: it gives
null for spaces or brackets where the split still works.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dictionaries as D
from .text import col, strip_ws

URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"

# Schemes urllib treats as hierarchical (params split, "//" kept on rebuild).
_PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
                  "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")
_NETLOC_SCHEMES = ("ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms",
                   "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync",
                   "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services")


# A column *name* gives one SQL expression (parsed by the JVM in one call);
# a Column is composed with the Column API.

def scheme(c) -> Column:
    if isinstance(c, str):
        return F.expr(f"lower({_part_sql(_ref(c), 1)})")
    return F.lower(F.regexp_extract(col(c), URL_RE, 1))


def netloc(c) -> Column:
    if isinstance(c, str):
        return F.expr(_part_sql(_ref(c), 2))
    return F.regexp_extract(col(c), URL_RE, 2)


def host(c) -> Column:
    """Lower-cased authority (user-info and port included)."""
    if isinstance(c, str):
        return F.expr(f"lower({_part_sql(_ref(c), 2)})")
    return F.lower(netloc(c))


def split_path(c) -> Column:
    """Path as ``urlsplit`` gives it."""
    if isinstance(c, str):
        return F.expr(_part_sql(_ref(c), 3))
    return F.regexp_extract(col(c), URL_RE, 3)


def path(c) -> Column:
    """Path as ``urlparse`` gives it: ``;params`` of the last segment removed."""
    if isinstance(c, str):
        r = _ref(c)
        schemes = ", ".join(_lit(x) for x in _PARAM_SCHEMES)
        p = _part_sql(r, 3)
        return F.expr(f"CASE WHEN lower({_part_sql(r, 1)}) IN ({schemes}) "
                      f"THEN regexp_replace({p}, ';[^/]*$', '') ELSE {p} END")
    p = split_path(c)
    return F.when(scheme(c).isin(*_PARAM_SCHEMES), F.regexp_replace(p, ";[^/]*$", "")).otherwise(p)


def query(c) -> Column:
    if isinstance(c, str):
        return F.expr(_part_sql(_ref(c), 4))
    return F.regexp_extract(col(c), URL_RE, 4)


def fragment(c) -> Column:
    if isinstance(c, str):
        return F.expr(_part_sql(_ref(c), 5))
    return F.regexp_extract(col(c), URL_RE, 5)


def is_http_url(c) -> Column:
    """Scheme http(s) and a non-empty authority."""
    if isinstance(c, str):
        r = _ref(c)
        return F.expr(f"(lower({_part_sql(r, 1)}) IN ('http', 'https') AND {_part_sql(r, 2)} <> '')")
    return scheme(c).isin("http", "https") & (netloc(c) != "")


def quote_plus(c) -> Column:
    """``quote_plus`` = Java URL encoding with '*' and '~' fixed."""
    enc = F.url_encode(col(c))
    return F.replace(F.replace(enc, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def unsplit(sch: Column, net: Column, pth: Column, qry: Column, frag: Column) -> Column:
    """``urlunsplit`` of five string columns (empty = absent)."""
    with_net = (net != "") | (sch.isin(*_NETLOC_SCHEMES) & ~pth.startswith("//"))
    slash = F.when((pth != "") & ~pth.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    body = F.when(with_net, F.concat(F.lit("//"), net, slash, pth)).otherwise(pth)
    return F.concat(
        F.when(sch != "", F.concat(sch, F.lit(":"))).otherwise(F.lit("")),
        body,
        F.when(qry != "", F.concat(F.lit("?"), qry)).otherwise(F.lit("")),
        F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
    )


def normalize_link(name: str) -> Column:
    """U2 over the column ``name``: trim; drop ``utm_*`` query parameters (case-insensitive).

    Without a query the trimmed link is returned as is.  Otherwise the
    remaining pairs are decoded and re-encoded in order, blank values kept,
    and the URL is rebuilt (fragment kept).
    """
    return F.expr(normalize_text(_ref(name)))


def is_likely_content_link(source_url, link, min_depth: int = 2) -> Column:
    """Path non-empty, differs from the source path, no blocked token, deep enough."""
    src_path = F.regexp_replace(path(source_url), "/+$", "")
    p = F.regexp_replace(path(link), "/+$", "")
    lowered = F.lower(p)
    blocked = F.lit(False)
    for tok in D.BLOCKED_LINK_TOKENS:
        blocked = blocked | lowered.contains(tok)
    depth = F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))
    return (p != "") & (p != src_path) & ~blocked & (depth >= min_depth)


def same_host(source_url, link) -> Column:
    """Link authority equals source authority (both lower-cased)."""
    return host(link) == host(source_url)


def is_repository_link(link) -> Column:
    """Code-host link with exactly two non-empty path parts, not a site page."""
    # exactly two non-empty parts when split on "/" <=> /*seg/+seg/*
    p = path(link)
    first = F.regexp_extract(p, r"^/*([^/]+)", 1)
    return (host(link).isin(*D.CODE_HOSTS) & p.rlike(r"^/*[^/]+/+[^/]+/*$")
            & ~F.lower(first).isin(*D.BLOCKED_REPO_SEGMENTS))


def is_paper_link(link) -> Column:
    """P10: paper host and a path starting with /abs/."""
    return host(link).isin(*D.PAPER_HOSTS) & path(link).startswith("/abs/")


def feed_url_for_source(source_url) -> Column:
    """Feed URL of a listing page (query and fragment dropped)."""
    s = col(source_url)
    p = F.regexp_replace(split_path(s), "/+$", "")
    on_feed_host = host(s).isin(*D.FEED_HOSTS)
    new_path = F.when(on_feed_host, F.concat(F.lit("/feed"), p)).otherwise(F.lit("/feed"))
    return unsplit(scheme(s), netloc(s), new_path, F.lit(""), F.lit(""))


def feed_url_for_article(article_url) -> Column:
    """Feed URL that lists an article, or null."""
    s = col(article_url)
    h = host(s)
    p = F.regexp_replace(split_path(s), "/+$", "")
    first = F.substring_index(F.regexp_replace(p, "^/+", ""), "/", 1)
    on_feed_host = h.isin(*D.FEED_HOSTS)
    return (
        F.when(p == "", F.lit(None))
        .when(on_feed_host & (first == ""), F.lit(None))
        .when(on_feed_host, unsplit(scheme(s), netloc(s), F.concat(F.lit("/feed/"), first), F.lit(""), F.lit("")))
        .when(h.endswith(".medium.com"), unsplit(scheme(s), netloc(s), F.lit("/feed"), F.lit(""), F.lit("")))
    )


# ---------------------------------------------------------------------------
# Functions as single SQL expressions over named columns or lambda variables: one
# expression string is parsed by the JVM at once instead of being built
# from hundreds of Column calls.
# ---------------------------------------------------------------------------

def _lit(s: str) -> str:
    out = []
    for ch in s:
        if ch in "\\'":
            out.append("\\" + ch)
        elif ch.isprintable() and ord(ch) < 0x80:
            out.append(ch)
        else:
            out.append("\\u%04x" % ord(ch) if ord(ch) < 0x10000 else "\\U%08x" % ord(ch))
    return "'" + "".join(out) + "'"


def _ref(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _strip_sql(e: str) -> str:
    from .text import WS_CHARS

    return f"trim(BOTH {_lit(WS_CHARS)} FROM {e})"


def _part_sql(e: str, i: int) -> str:
    return f"regexp_extract({e}, {_lit(URL_RE)}, {i})"


def _unsplit_sql(sch: str, net: str, pth: str, qry: str, frag: str) -> str:
    schemes = ", ".join(_lit(x) for x in _NETLOC_SCHEMES)
    return (f"concat(CASE WHEN {sch} <> '' THEN concat({sch}, ':') ELSE '' END, "
            f"CASE WHEN {net} <> '' OR ({sch} IN ({schemes}) AND NOT startswith({pth}, '//')) "
            f"THEN concat('//', {net}, CASE WHEN {pth} <> '' AND NOT startswith({pth}, '/') THEN '/' ELSE '' END, {pth}) "
            f"ELSE {pth} END, "
            f"CASE WHEN {qry} <> '' THEN concat('?', {qry}) ELSE '' END, "
            f"CASE WHEN {frag} <> '' THEN concat('#', {frag}) ELSE '' END)")


def let(var: str, value: str, body: str) -> str:
    """SQL: ``body`` with the lambda variable ``var`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {var} -> {body})[0]"


def normalize_text(name: str) -> str:
    """U2 as SQL text over a column reference or lambda variable."""
    # As query strings are read: '+' is a space, then valid escapes are decoded; a '%' without two
    # hex digits stands for itself.
    def dec(e: str) -> str:
        return f"try_url_decode(regexp_replace({e}, '%(?![0-9A-Fa-f]{{2}})', '%25'))"

    def enc(e: str) -> str:
        return f"replace(replace(url_encode({e}), '*', '%2A'), '%7E', '~')"

    key = "substring_index(x, '=', 1)"
    val = f"CASE WHEN instr(x, '=') > 0 THEN {dec('substring(x, instr(x, ' + _lit('=') + ') + 1)')} ELSE '' END"
    newq = (f"array_join(transform(filter(filter(split(q_, '&'), x -> x <> ''), "
            f"x -> NOT startswith(lower({dec(key)}), 'utm_')), "
            f"x -> concat({enc(dec(key))}, '=', {enc(val)})), '&')")
    sch = f"lower({_part_sql('l_', 1)})"
    rebuilt = _unsplit_sql(sch, _part_sql("l_", 2), _part_sql("l_", 3), "n_", _part_sql("l_", 5))
    # A link without a question mark has no query, so most links need no pattern at all.
    return let("l_", _strip_sql(name), "CASE WHEN instr(l_, '?') = 0 THEN l_ ELSE " + let(
        "q_", _part_sql("l_", 4), f"CASE WHEN q_ = '' THEN l_ ELSE {let('n_', newq, rebuilt)} END") + " END")


def base_sql(base: str) -> str:
    """A base given as a URL literal or as a column name, as SQL text."""
    return _lit(base) if "://" in base else _ref(base)


def urljoin_text(base: str, href: str) -> str:
    """L2: ``urllib.parse.urljoin(base, href)`` for http(s) bases as SQL text over two SQL expressions.

    Absolute and ``//host`` references are taken as they are; a rooted or relative path is merged with
    the base directory, empty middle segments are dropped and dot segments removed with a stack; an
    empty path keeps the base path and, without its own query, the base query.  Every part is
    computed once, bound to a lambda variable, and only in the case that needs it."""
    # As the standard library reads it: no leading controls or blanks, no tabs or line breaks.
    clean = f"regexp_replace(regexp_replace({href}, '^[\\\\x00-\\\\x20]+', ''), '[\\\\t\\\\r\\\\n]', '')"
    h_scheme = "lower(regexp_extract(c_, '^([A-Za-z][A-Za-z0-9+.\\\\-]*):', 1))"
    # A reference that repeats the base's scheme is read without it; an empty authority is none.
    h = ("CASE WHEN s_ <> '' AND s_ = bs_ THEN regexp_replace(c_, '^[^:]*:', '') ELSE c_ END")
    h = let("a_", h, "CASE WHEN a_ rlike '^//([/?#]|$)' THEN substring(a_, 3) ELSE a_ END")
    b_net, b_path, b_query = (_part_sql("b_", i) for i in (2, 3, 4))
    merged = "CASE WHEN startswith(d_, '/') THEN d_ ELSE concat(regexp_replace(bp_, '[^/]*$', ''), d_) END"
    segs = let("g_", f"split({merged}, '/')", "filter(g_, (x, i) -> x <> '' OR i = 0 OR i = size(g_) - 1)")
    stack = ("aggregate(k_, CAST(array() AS array<string>), (acc, s) -> CASE WHEN s = '..' "
             "THEN slice(acc, 1, greatest(size(acc) - 1, 0)) WHEN s = '.' THEN acc ELSE concat(acc, array(s)) END)")
    stack = f"CASE WHEN try_element_at(k_, -1) IN ('.', '..') THEN concat({stack}, array('')) ELSE {stack} END"
    path = let("d_", "regexp_replace(p_, ';[^/]*$', '')", let("k_", segs, let(
        "j_", f"array_join({stack}, '/')", "concat(CASE WHEN j_ = '' THEN '/' ELSE j_ END, "
        "regexp_replace(regexp_extract(p_, '(;[^/]*)$', 1), '^;$', ''))")))
    query = "regexp_extract(h_, '^[^?#]*\\\\?([^#]*)', 1)"
    fragment_ = "regexp_extract(h_, '#([\\\\s\\\\S]*)$', 1)"
    whole = _unsplit_sql("bs_", "bn_", "bp_", b_query, "''")
    kept = let("w_", query, _unsplit_sql("bs_", "bn_", "bp_", f"CASE WHEN w_ <> '' THEN w_ ELSE {b_query} END", fragment_))
    other = let("f_", "concat(bs_, ':', h_)", _unsplit_sql("bs_", *[_part_sql("f_", i) for i in (2, 3, 4, 5)]))
    joined = let("m_", path, _unsplit_sql("bs_", "bn_", "m_", query, fragment_))
    relative = let("bn_", b_net, let("bp_", b_path, f"CASE WHEN h_ = '' THEN {whole} WHEN p_ = '' THEN {kept} ELSE {joined} END"))
    body = (f"CASE WHEN s_ <> '' AND s_ <> bs_ THEN {href} WHEN startswith(h_, '//') THEN {other} "
            f"ELSE {let('p_', _first_part('h_'), relative)} END")
    return let("c_", clean, let("b_", base, let("bs_", f"lower({_part_sql('b_', 1)})", let("s_", h_scheme, let("h_", h, body)))))


def _first_part(e: str) -> str:
    return f"regexp_extract({e}, '^([^?#]*)', 1)"


def urljoin_sql(base: str, href: str) -> Column:
    """L2 over a base given as SQL text (see :func:`base_sql`) and the column ``href``."""
    return F.expr(urljoin_text(base, _ref(href)))
